"""Shifted-row realignment for day-first SD text reports.

Free-text cells that contained the separator were split into extra cells,
pushing later cells right (and the last ones off the row).  Each rule below
recognises one shift pattern from which cells look like dates, and moves the
cells back, re-joining the split text.  The first matching rule wins; a null
condition falls through to the next rule.

The rule table is data; it is compiled into two projections: one computing
``shift_kind`` once per row, one picking every target cell by that kind.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.text import date_shape
from ledgerline.spec import SD_MOVABLE

# Short codes of the movable cells, in row order; spec.SD_MOVABLE has their column names.
CELLS = ("N", "FN", "TE", "FR", "FU", "NA", "RA", "CB", "BK", "VD", "VH", "US", "RD")
CELL_COLUMNS = dict(zip(CELLS, SD_MOVABLE, strict=True))


@dataclass(frozen=True)
class Join:
    """Target cell built by joining source cells with a separator (null if any is null)."""
    sep: str
    parts: tuple[str, ...]


@dataclass(frozen=True)
class Rule:
    kind: int
    dated: tuple[str, ...]        # cells that must look like dates
    undated: tuple[str, ...]      # cells that must not
    targets: tuple[object, ...]   # per target cell: source cell name, Join, or None


# The five shift patterns, in evaluation order.
RULES = (
    Rule(1, dated=("FU", "VH"), undated=("VD",),
         targets=(Join(" ", ("N", "FN")), "TE", "FR", "FU", "NA", "RA", "CB", "BK", "VD", "VH", "US",
                  "RD", None)),
    Rule(2, dated=("FU",), undated=("VD", "VH"),
         targets=(Join(" ", ("N", "FN")), "TE", "FR", "FU", "NA", "RA", "CB", "BK",
                  Join(" ", ("VD", "VH")), "US", "RD", None, None)),
    Rule(3, dated=("FR",), undated=("VD",),
         targets=("N", "FN", "TE", "FR", "FU", "NA", "RA", "CB", Join(" ", ("BK", "VD")), "VH", "US",
                  "RD", None)),
    Rule(4, dated=("NA", "US"), undated=(),
         targets=(Join(",", ("N", "FN", "TE")), "FR", "FU", "NA", "RA", "CB", "BK", "VD", "VH", "US",
                  "RD", None, None)),
    Rule(5, dated=("NA",), undated=("US",),
         targets=(Join(",", ("N", "FN", "TE")), "FR", "FU", "NA", "RA", "CB", "BK", "VD",
                  Join(",", ("VH", "US")), "RD", None, None, None)),
)


def _cell(name: str) -> Column:
    return F.col(CELL_COLUMNS[name])


def _flag(name: str) -> str:
    return f"__shaped_{name}"


def _condition(rule: Rule, flags: bool = False) -> Column:
    shaped = (lambda n: F.col(_flag(n))) if flags else (lambda n: date_shape(_cell(n)))
    cond = None
    for name in rule.dated:
        c = shaped(name)
        cond = c if cond is None else cond & c
    for name in rule.undated:
        c = ~shaped(name)
        cond = c if cond is None else cond & c
    return cond


def tested_cells(rules=RULES) -> list[str]:
    """Cells whose date shape the rules test, in first-use order."""
    out: list[str] = []
    for r in rules:
        for n in (*r.dated, *r.undated):
            if n not in out:
                out.append(n)
    return out


def _target(spec) -> Column:
    if spec is None:
        return F.lit(None).cast("string")
    if isinstance(spec, Join):
        parts = []
        for i, p in enumerate(spec.parts):
            if i:
                parts.append(F.lit(spec.sep))
            parts.append(_cell(p))
        return F.concat(*parts)  # null-propagating on purpose, never concat_ws
    return _cell(spec)


def shift_kind(rules=RULES, flags: bool = False) -> Column:
    """0 for a clean row, else the kind of the first matching rule.

    With ``flags`` the conditions read precomputed ``__shaped_<cell>`` columns.
    """
    expr = None
    for rule in rules:
        cond = _condition(rule, flags)
        expr = F.when(cond, F.lit(rule.kind)) if expr is None else expr.when(cond, F.lit(rule.kind))
    return expr.otherwise(F.lit(0))


def realign(df: DataFrame, kind_column: str | None = None, rules=RULES) -> DataFrame:
    """Move shifted SD cells back in place.  Row count is unchanged.

    ``df`` must carry the 13 movable SD columns (stripped).  Other columns
    pass through.  With ``kind_column`` the detected kind is kept.
    """
    kind_col = kind_column or "__shift_kind"
    # each tested cell's shape once per row (a cell appears in up to 3 rules)
    names = tested_cells(rules)
    shaped = df.withColumns({_flag(n): date_shape(_cell(n)) for n in names})
    marked = shaped.withColumn(kind_col, shift_kind(rules, flags=True)).drop(*[_flag(n) for n in names])
    k = F.col(kind_col)
    moved = {}
    for i, target in enumerate(CELLS):
        expr = None
        for rule in rules:
            v = _target(rule.targets[i])
            expr = F.when(k == rule.kind, v) if expr is None else expr.when(k == rule.kind, v)
        moved[CELL_COLUMNS[target]] = expr.otherwise(_cell(target))
    out = marked.withColumns(moved)
    return out if kind_column else out.drop(kind_col)
