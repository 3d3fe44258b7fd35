"""Digests of files: equal for equal content whatever the splits, different for any change."""

import hashlib

from wavemill.sources.digest import content_digests


def digests(spark, paths, whole, split):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, split)
    try:
        rows = content_digests(spark, [str(p) for p in paths], whole).collect()
    finally:
        spark.conf.set(key, before)
    return {r.path.rsplit("/", 1)[-1]: (r.bytes, r.sha256) for r in rows}


def test_large_files_by_their_lines(spark, tmp_path):
    lines = [f"{i},Straße {i * 7919 % 1000},{'x' * (i % 90)}\r".encode() for i in range(20_000)]
    lines[77] = b"\xff\xfe no text \x00"
    lines[5_000] = b""
    body = b"\n".join(lines) + b"\n"
    swapped = [*lines]
    swapped[9_000], swapped[15_000] = swapped[15_000], swapped[9_000]
    contents = {"a": body, "same": body, "no_last_break": body[:-1], "one_byte": body.replace(b"Stra", b"stra", 1),
                "swapped": b"\n".join(swapped) + b"\n", "more": body + b"\n", "cr": body.replace(b"\r", b"", 1)}
    for name, content in contents.items():
        (tmp_path / name).write_bytes(content)
    paths = [tmp_path / n for n in contents]
    found = digests(spark, paths, 1000, "64k")
    assert {n: b for n, (b, _) in found.items()} == {n: len(c) for n, c in contents.items()}
    assert found["a"] == found["same"]
    assert len({d for _, d in found.values()}) == len(contents) - 1
    assert all(len(d) == 64 for _, d in found.values())
    assert found == digests(spark, paths, 1000, "100m")
    assert found["a"] == digests(spark, paths[:1], 1000, "333k")["a"]  # other files do not matter


def test_files_that_fit_have_their_plain_hash(spark, tmp_path):
    contents = {"empty": b"", "limit": b"x" * 1000, "above": b"y" * 1001}
    for name, content in contents.items():
        (tmp_path / name).write_bytes(content)
    found = digests(spark, [tmp_path / n for n in contents], 1000, "64k")
    plain = {n: hashlib.sha256(c).hexdigest() for n, c in contents.items()}
    assert set(found) == {"limit", "above"}  # Spark's readers pass over empty files
    assert found["limit"] == (1000, plain["limit"]) and found["above"][1] != plain["above"]
