"""Stacking and blending operators.

Scale notes
-----------
* Stacks use ``unionByName`` after every branch is aligned to one contract, so
  a branch with a different column order can never shift values (the
  reference's positional UNION pitfall). A union adds no shuffle.
* ``full_outer_blend`` expects each input to be unique on its join keys (the
  callers aggregate first, which is also map-side combined). A key is then at
  most one row per side, so a hot dimension value cannot pile up in one join
  task. Rows whose key holds a NULL never match anything.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from blendwise import constants as K
from blendwise.functions.columns import any_positive


# ---------------------------------------------------------------- contracts --

def _contract_items(contract) -> list[tuple[str, str]]:
    if isinstance(contract, StructType):
        return [(f.name, f.dataType.simpleString()) for f in contract.fields]
    items = []
    for item in contract:
        if isinstance(item, str):
            items.append((item, None))
        else:
            name, dtype = item
            items.append((name, dtype.simpleString() if isinstance(dtype, DataType) else dtype))
    return items


def align_to(df: DataFrame, contract, measures: Sequence[str] = (), fill=0) -> DataFrame:
    """Select ``df`` into a column contract.

    Missing measure columns become ``fill`` (zero padding); missing other
    columns become typed NULLs. Present columns are cast to the contract type.
    ``contract`` is a StructType or a sequence of names / (name, type) pairs.
    """
    measures = set(measures)
    present = set(df.columns)
    cols = []
    for name, dtype in _contract_items(contract):
        if name in present:
            c = F.col(f"`{name}`")
        elif name in measures:
            c = F.lit(fill)
        else:
            c = F.lit(None)
        if dtype is not None:
            c = c.cast(dtype)
        cols.append(c.alias(name))
    return df.select(*cols)


def stack(dfs: Sequence[DataFrame], distinct: bool = False) -> DataFrame:
    """``UNION ALL`` by name (U1); ``distinct=True`` gives ``UNION``."""
    out = reduce(lambda a, b: a.unionByName(b), dfs)
    return out.distinct() if distinct else out


def stack_channels(branches: Sequence[Mapping], contract, measures: Sequence[str]) -> DataFrame:
    """Per-platform selects into one contract, labelled and zero-padded.

    Each branch is a mapping with ``df`` and optional ``rename`` (source ->
    contract name), ``const`` (contract name -> literal or Column), ``where``
    (boolean Column applied before projection).
    """
    parts = []
    for b in branches:
        df = b["df"]
        if b.get("where") is not None:
            df = df.filter(b["where"])
        rename = dict(b.get("rename", {}))
        const = dict(b.get("const", {}))
        cols = [F.col(f"`{src}`").alias(dst) for src, dst in rename.items()]
        kept = set(rename.values()) | set(const)
        cols += [F.col(f"`{c}`") for c in df.columns
                 if c not in rename and c not in kept]
        cols += [(v if isinstance(v, Column) else F.lit(v)).alias(k) for k, v in const.items()]
        parts.append(align_to(df.select(*cols), contract, measures))
    return stack(parts)


def stack_relations(dfs: Sequence[DataFrame]) -> DataFrame:
    """Stack upstream relations that must share one schema.

    The reference stacks by position; here the schemas are checked for equal
    names and types first, so a drifted upstream fails loudly.
    """
    first = dfs[0].schema
    for i, df in enumerate(dfs[1:], start=1):
        a = [(f.name, f.dataType) for f in first.fields]
        b = [(f.name, f.dataType) for f in df.schema.fields]
        if a != b:
            raise ValueError(f"relation {i} schema {b} differs from {a}")
    return stack(dfs)


def split_channels(df: DataFrame, rules: Sequence[tuple], label_col: str = "channel") -> DataFrame:
    """One scan labelled by several filters.

    ``rules`` holds ``(label, condition)``. A row is emitted once for every
    rule it satisfies -- the same rows the reference gets from one filtered
    scan per label stacked with UNION ALL, but reading the source once. NULL
    conditions count as not satisfied.
    """
    labels = F.array(*[F.when(cond, F.lit(label)) for label, cond in rules])
    return (df.withColumn(label_col, F.explode(F.filter(labels, lambda x: x.isNotNull()))))


# ----------------------------------------------------------------- filters --

def active_rows(df: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Keep rows with any positive measure."""
    return df.filter(any_positive(*measures))


def soft_delete(df: DataFrame, flag_col: str = "_fivetran_deleted") -> DataFrame:
    """``"_fivetran_deleted" = FALSE`` -- NULL flags are dropped too."""
    return df.filter(F.col(f"`{flag_col}`") == F.lit(False))


# ------------------------------------------------------------------ blends --

def full_outer(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``left FULL OUTER JOIN right USING (keys)``: keys first, then left, then right.

    Inputs aggregated on the join keys keep their partitioning, so the join adds no
    shuffle. Rows with a NULL in a key match nothing and spread by their other keys.
    """
    keys = list(keys)
    out_cols = keys + [c for c in left.columns if c not in keys] + \
        [c for c in right.columns if c not in keys]
    return left.join(right, keys, "full").select(*[F.col(f"`{c}`") for c in out_cols])


def full_outer_blend(inputs: Sequence[tuple[DataFrame, Sequence[str]]],
                     fill_measures: Sequence[str] | None = None, fill=0) -> DataFrame:
    """Chained full outer joins with coalesced keys, measures zero-filled.

    ``inputs`` is ``[(df0, None), (df1, keys1), (df2, keys2), ...]``: each
    further input joins the running result on its own key list (key sets may
    shrink, which fans out exactly as the SQL does). ``fill_measures`` lists
    columns to ``COALESCE(x, fill)`` at the end.
    """
    out = inputs[0][0]
    for df, keys in inputs[1:]:
        out = full_outer(out, df, keys)
    if fill_measures:
        out = out.withColumns({m: F.coalesce(F.col(m), F.lit(fill)) for m in fill_measures})
    return out


def campaign_dimension(sources: Sequence[tuple[DataFrame, str, str, str]],
                       dedupe_names: bool = False) -> DataFrame:
    """Distinct (channel, campaign_id, campaign_name) from paid tables.

    ``sources`` holds ``(df, channel_label, id_col, name_col)``; ids are cast to
    text. With ``dedupe_names=True`` an id keeps only its smallest name, so a
    later join cannot fan out (quirk Q12 repaired).
    """
    parts = [df.select(F.lit(label).alias("channel"),
                       F.col(id_col).cast("string").alias("campaign_id"),
                       F.col(name_col).cast("string").alias("campaign_name"))
             for df, label, id_col, name_col in sources]
    dim = stack(parts).distinct()  # one shuffle; duplicates are dropped map-side first
    if dedupe_names:
        dim = dim.groupBy("channel", "campaign_id").agg(F.min("campaign_name").alias("campaign_name"))
    return dim


def store_block(sales: DataFrame, contract, measures: Sequence[str],
                rename: Mapping[str, str], const: Mapping[str, object] | None = None) -> DataFrame:
    """Store rows as a pseudo-channel with zero paid measures."""
    const = {"channel": K.STORE_CHANNEL, **dict(const or {})}
    return stack_channels([{"df": sales, "rename": rename, "const": const}], contract, measures)


def app_blend(paid: DataFrame, mmp: DataFrame, keys: Sequence[str], measures: Sequence[str],
              id_col: str = "campaign_id", not_set: str = K.NOT_SET) -> DataFrame:
    """Paid app campaigns full-outer-joined to MMP facts on ``keys``; missing ids
    become ``not_set`` and measures are zero-filled sums per key and id (R38).
    """
    blended = full_outer_blend([(paid, None), (mmp, keys)])
    return (blended.groupBy(*keys, F.coalesce(F.col(id_col), F.lit(not_set)).alias(id_col))
            .agg(*[F.sum(F.coalesce(F.col(m), F.lit(0))).alias(m) for m in measures]))


def regional_paid_spend(branches: Sequence[Mapping], keys: Sequence[str] = ("region", "date"),
                        drop_region: str | None = "Other") -> DataFrame:
    """Paid spend per region and day with a per-branch 'paid' definition.

    Each branch: ``df`` (``date, region, spend, revenue, purchases``), optional
    ``where`` (row filter, e.g. region whitelist and name exclusions) and
    ``paid`` (Column for ``paid_spend``, default the spend). Rows of region
    ``drop_region`` are dropped; measures are zero-filled sums. Branches that
    share one source DataFrame are evaluated in a single pass over it: each row
    is emitted once per branch whose filter it satisfies (UNION ALL semantics).
    """
    groups: dict[int, list] = {}
    for b in branches:
        groups.setdefault(id(b["df"]), []).append(b)
    parts = []
    for group in groups.values():
        df = group[0]["df"]
        arms = []
        for b in group:
            cond = b.get("where") if b.get("where") is not None else F.lit(True)
            paid = b.get("paid") if b.get("paid") is not None else F.col("spend")
            arms.append(F.when(cond, F.struct(paid.cast("double").alias("p"))))
        chosen = F.explode(F.filter(F.array(*arms), lambda x: x.isNotNull())).alias("__arm")
        parts.append(df.select(F.col("date").cast("date").alias("date"), "region",
                               F.col("spend").cast("double").alias("spend"),
                               F.col("revenue").cast("double").alias("paid_revenue"),
                               F.col("purchases").cast("long").alias("paid_purchases"), chosen)
                     .select("date", "region", "spend", F.col("__arm.p").alias("paid_spend"),
                             "paid_revenue", "paid_purchases"))
    out = stack(parts)
    if drop_region is not None:
        out = out.filter(F.col("region") != F.lit(drop_region))
    cols = ["spend", "paid_spend", "paid_revenue", "paid_purchases"]
    return out.groupBy(*keys).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in cols])
