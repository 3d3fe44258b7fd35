"""Small exports and forms with the oddities real ones have."""

from __future__ import annotations

import csv
import os

from wavemill import config

NBSP = " "
DISTRICTS = {"Kanungu": 1, "Mitooma": 2}
# Codes of the first cycle differ from those of the later ones.
DISTRICT_CODES = {"baseline": {"Kanungu": "1", "Mitooma": "2"},
                  "year1": {"Kanungu": "7", "Mitooma": "8"},
                  "year2": {"Kanungu": "7", "Mitooma": "8"}}


def headers(cycle: str) -> list[str]:
    """Contract headers of a cycle in its own spelling."""
    out = []
    for name, _, names in config.VARIABLE_SPEC:
        header = names[0]
        if cycle != "year2" and name in ("cohort", "inc_vsla_profits_usd", "inc_vegetables_usd"):
            continue
        if cycle == "baseline":
            if name in ("assets_usd", "livestock_asset_usd"):
                continue
            header = {"cluster": "Pre_cluster",
                      "consumption_residues_usd_year": "Consumption (USD)"}.get(name, header)
        else:
            if name in ("gps_lat", "gps_lon"):
                continue
            header = {"inc_rent_usd": "Rent Income (Property & Land) USD"}.get(name, header)
            if cycle == "year2" and name == "consumption_residues_usd_year":
                header = "Consumption + Residues(USD)"
        out.append(header)
    return out


def stamp(cycle: str, day: int, hour: int) -> str:
    return {"baseline": f"6/{day}/2020, {hour}:49:56 AM",
            "year1": f"Aug {day}, 2022 {hour}:47:35 AM",
            "year2": f"2023-08-{day:02d} {hour:02d}:06:47" + (".250000" if day % 2 else "")}[cycle]


def record(cycle: str, key: str, household: str, day: int, district: str, village: str,
           **other: str) -> dict[str, str]:
    """One interview; codes carry '.0' in the second cycle."""
    def code(value):
        return f"{value}.0" if cycle == "year1" and value else value

    row = {"KEY": key, "SubmissionDate": stamp(cycle, day, 9), "starttime": stamp(cycle, day, 8),
           "endtime": stamp(cycle, day, 9), "duration": "3600", "formdef_version": "2101.0",
           "enumerator": "NA", "hhid_2": household, "hhid_2_again": household, "status": code("1"),
           "consent_1": code("1"), "district": code(DISTRICT_CODES[cycle][district]),
           "pre_district": district, "pre_subcounty": "Kayonza", "pre_parish": "Bujengwe",
           "pre_cluster": "C1", "Pre_cluster": "C1", "pre_village": village, "pre_cohort": "2022",
           "Quartile": "Q2", "respondent": code("1"), "hh_size": code("4"), "hhh_sex": code("1"),
           "hhh_age": code("40"), "HH Income + Consumption + Residues/Day (USD)": "1.5",
           "HH Income + Consumption + Residues (USD)": "547.5", "HH Income (USD)": "400",
           "Seasonal Crops Income (USD)": "100", "Total Savings (Ugx)": "1000",
           "Material_roof": code("1"), "GPS-Latitude": "-0.9"}
    return {**row, **other}


def rows(cycle: str) -> list[dict[str, str]]:
    prefix = {"baseline": "b", "year1": "y", "year2": "z"}[cycle]
    out = [
        record(cycle, f"{prefix}1", "KAN-KAY-BUJ-K0001", 3, "Kanungu", "Kyeshero"),
        record(cycle, f"{prefix}2", "Kan-kay-buj-k0002", 4, "Kanungu", "KYESHERO ",
               enumerator='says "hi",\nthen leaves'),
        record(cycle, f"{prefix}3", f"MIT-NYA-M{NBSP}-U{NBSP}11019", 5, "Mitooma", "Nyakizinga"),
        # A later submission of household 1 supersedes the first.
        record(cycle, f"{prefix}4", "KAN-KAY-BUJ-K0001 ", 9, "Kanungu", "Kyeshero", hh_size="5"),
        record(cycle, f"{prefix}5", "", 6, "Kanungu", "Kyeshero"),
        # The key of a row without household is used again.
        record(cycle, f"{prefix}5", "KAN-KAY-BUJ-K0009", 6, "Kanungu", "Kyeshero"),
    ]
    if cycle == "year1":
        out.append({"pre_village": "left over"})
        out.append({"pre_village": "left over"})
    if cycle != "year1":
        out.append(record(cycle, f"{prefix}7", "KAN-KAY-BUJ-K0007", 7, "Kanungu", "Kyeshero",
                          consent_1="0", hhh_age="3.5"))
    return out


def write_exports(folder: str) -> None:
    os.makedirs(folder, exist_ok=True)
    for cycle in config.CYCLES:
        names = headers(cycle.code)
        extra = ["Status", "Total Savings (Ugx)", "hhmem_1", "hhmem_2", "Loan_from_97", "never"]
        padded = [f" {n} " if n == "hh_size" else n.replace("HH Income (USD)", "HH  Income (USD)")
                  for n in names]
        with open(f"{folder}/{cycle.export}", "w", newline="", encoding="utf-8") as f:
            out = csv.writer(f)
            out.writerow(["", *padded, *extra])
            for i, row in enumerate(rows(cycle.code)):
                filled = "KEY" in row
                tail = ["org", "999", "Ann", "", "1", ""] if filled else [""] * 6
                out.writerow([str(i), *[row.get(n, "") for n in names], *tail])


def entry(name: str, question: str, choices: list[tuple[str, str]], required: bool = False) -> str:
    table = "".join(f"<tr><td>{i}<td>{code}</td><td> {label} </td></tr>"
                    for i, (code, label) in enumerate(choices))
    mark = " <span>(required)</span>" if required else ""
    cell = f"<table>{table}</table>" if choices else ""
    return (f'<tr class="entryRow even"><td class="fieldCell">{name}{mark}</td>'
            f'<td class="questionCell"><b>{question}</b> please &amp; thanks</td><td>{cell}</td></tr>')


def write_forms(folder: str) -> None:
    os.makedirs(folder, exist_ok=True)
    for cycle in config.CYCLES:
        later = cycle.code != "baseline"
        district = [(c, d) for d, c in DISTRICT_CODES[cycle.code].items()]
        body = [
            '<tr class="entryRow"><td colspan="3">Household  group</td></tr>',
            entry("hhid_2", "Household?", [], True),
            entry("district", "District?", district + [("", "skipped")]),
            entry("hhh_sex", "Sex?", [("1", "Male"), ("2", "Female")]),
            entry("respondent", "Who?", [("1", "[Head] of household"), ("2", "Spouse")]),
            '<tr class="entryRow"><td colspan="3">Housing</td></tr>',
            entry("Material_roof", "Roof?", [("1", "Iron Sheets" if later else "iron sheets"),
                                             ("2", "Thatch/Tins/Grass" if later else "Thatch/Tins")]),
            entry("hhmem", "Member?", []),
            entry("Loan_from", "Lender?", [("97", "Bank")]),
            '<tr class="other"><td class="fieldCell">not a field</td></tr>',
        ]
        with open(f"{folder}/{cycle.form}", "w", encoding="utf-8") as f:
            f.write("<html><body><table>" + "\n".join(body) + "</table></body></html>")
