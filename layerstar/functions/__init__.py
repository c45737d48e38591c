"""Column-level building blocks: dialect helpers (dates, text, formats) and the
cleansing steps T1-T23 that work on one row at a time."""
