"""Quote currencies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Hundredths, matched exactly, then in any case.
SUBUNITS_EXACT = {"GBp": "GBP", "ZAc": "ZAR", "ILa": "ILS"}
SUBUNITS_ANY_CASE = {"GBX": "GBP", "ZAC": "ZAR", "ILA": "ILS"}
#: Currencies that joined the euro, the day and the statutory units to the euro.
EURO_LEGACY = {
    "ATS": ("1999-01-01", 13.7603), "BEF": ("1999-01-01", 40.3399), "DEM": ("1999-01-01", 1.95583), "ESP": ("1999-01-01", 166.386),
    "FIM": ("1999-01-01", 5.94573), "FRF": ("1999-01-01", 6.55957), "IEP": ("1999-01-01", 0.787564), "ITL": ("1999-01-01", 1936.27),
    "LUF": ("1999-01-01", 40.3399), "NLG": ("1999-01-01", 2.20371), "PTE": ("1999-01-01", 200.482), "GRD": ("2001-01-01", 340.750),
    "SIT": ("2007-01-01", 239.640), "CYP": ("2008-01-01", 0.585274), "MTL": ("2008-01-01", 0.429300), "SKK": ("2009-01-01", 30.1260),
    "EEK": ("2011-01-01", 15.6466), "LVL": ("2014-01-01", 0.702804), "LTL": ("2015-01-01", 3.45280), "HRK": ("2023-01-01", 7.53450),
    "BGN": ("2026-01-01", 1.95583),
}


def lookup(table: dict, at: Column) -> Column:
    """The value of a key in a small table, by one map literal: ``at`` is evaluated once."""
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), at)


def iso(code: Column) -> Column:
    """The currency of account; null for a missing code."""
    c = F.trim(code)
    return F.when(c != "", F.coalesce(lookup(SUBUNITS_EXACT, c), lookup(SUBUNITS_ANY_CASE, F.upper(c)), F.upper(c)))


def unit(code: Column) -> Column:
    """What one quoted unit is in the currency of account."""
    c = F.trim(code)
    sub = c.isin(*SUBUNITS_EXACT) | F.upper(c).isin(*SUBUNITS_ANY_CASE)
    return F.when(sub, F.lit(0.01)).when(c != "", F.lit(1.0))
