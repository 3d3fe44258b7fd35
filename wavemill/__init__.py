"""wavemill: repeated household surveys as Spark DataFrame jobs.

Exports of several survey cycles go in as text; typed household x cycle rows,
a star schema, reports, a variable catalog and data-quality results come out.
"""
