"""Mixing sources to target weights, in DataFrame and SQL expressions only.

A source's weight is its token share to the power ``alpha``, normalised:
``alpha`` 1 keeps the corpus as it is, 0 weighs all sources alike. Two
bisections find ``alpha``: the largest one whose weights still have the entropy
``entropy`` * ln(number of sources), raised, if need be, until no source is
repeated more than ``repeats`` times within the token budget. A budget beyond
``repeats`` times the corpus is met by no exponent: every source then ends at its
limit, with fewer tokens than the budget.

The weights are realised exactly to a document: a source's quota (weight times
budget) buys whole passes over its documents and a part of one more. Each pass
is a permutation of its own: a document's place is an MD5 of seed, pass and
document, whose first three hex digits name one of 4096 blocks and the next
three a sub-block. The last, partial pass takes the longest beginning of its
permutation that fits the rest of the quota.

Plan: one scan reduces documents to (source, tokens, place); tokens are summed
per source, then per (source, block) to find the block where the quota ends,
then per sub-block there, then per place there. So a source with a third of all
rows is 4096 keys, and every window orders at most 4096 rows or one sub-block.
What is left is one cut-off per source. Tables of one row per source are stored
and, up to a counted ``BROADCAST_SOURCES`` rows, broadcast to the documents; beyond
that they are joined on the source.

Defined cases: words are runs without ASCII white space; null or blank texts have
no tokens (they cost nothing and come with every pass begun); a null source is a
source of its own; equal rows share their place and come together; sources
without tokens get weight 0 and no documents; extra columns are kept by ``mix``
(n_tokens, epoch and block of the input are replaced); texts of any length are counted whole;
an empty table gives no rows. Sources are assumed
to fit one array (their weights are found together).
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, scratch_path

WORD = r"[^\x20\x09-\x0D]+"
STEPS = 50
BROADCAST_SOURCES = 100_000
SEED, ENTROPY, REPEATS = "mix-1", 0.95, 4.0


def n_tokens() -> Column:
    return F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")


def place(epoch: Column, seed: str, key: str = "_key") -> Column:
    """32 hex digits: where a document stands in the permutation of a pass."""
    return F.md5(F.concat_ws("|", F.lit(seed), epoch.cast("string"), F.col(key)))


def doc_key() -> Column:
    return F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
                       F.coalesce(F.md5(F.col("text").cast("binary")), F.lit("")))


def weights(sources: DataFrame, entropy: float, repeats: float, budget: int | None) -> DataFrame:
    """source, tokens, alpha, weight, quota from (source, tokens)."""
    total = f"{budget}L" if budget is not None else "total"
    z = "aggregate(shares, 0D, (a, x) -> a + pow(x, {m}))"
    h = (f"(ln({z}) - {{m}} * aggregate(shares, 0D, (a, x) -> a + pow(x, {{m}}) * ln(x)) / {z})")
    # the smallest source is repeated most
    rep = f"(pow(shares[0], {{m}}) / {z} * {total} / (shares[0] * total))"

    def bisect(test: str, end: str) -> str:
        mid = "((s.lo + s.hi) / 2)"
        return (f"aggregate(sequence(1, {STEPS}), struct(0D as lo, 1D as hi), (s, i) -> "
                f"if({test.format(m=mid)}, struct({mid} as lo, s.hi as hi), "
                f"struct(s.lo as lo, {mid} as hi)), s -> s.{end})")

    goal = f"{entropy}D * ln(cast(size(shares) as double))"
    by_entropy = f"if({h.format(m='1D')} >= {goal}, 1D, {bisect(f'{h} >= {goal}', 'lo')})"
    by_repeats = f"if({rep.format(m='0D')} <= {repeats}D, 0D, {bisect(f'{rep} > {repeats}D', 'hi')})"
    solved = sources.where("tokens > 0").agg(
        F.array_sort(F.collect_list("tokens")).alias("t"), F.sum("tokens").alias("total")
    ).where("total > 0").withColumn(
        "shares", F.expr("transform(t, x -> x / cast(total as double))")).select(
        "total", "shares", F.expr(f"greatest({by_entropy}, {by_repeats})").alias("alpha")).withColumn(
        "z", F.expr(z.format(m="alpha")))
    # one row: a scalar subquery, not a join
    found = solved.select(F.struct("total", "alpha", "z")).scalar()
    w = F.expr("pow(tokens / cast(found.total as double), found.alpha) / found.z")
    all_tokens = F.lit(budget) if budget is not None else F.col("found.total")
    return sources.where("tokens > 0").withColumn("found", found).select(
        "source", "tokens", F.col("found.alpha").alias("alpha"), w.alias("weight"),
        F.least(F.floor(w * all_tokens + 0.5), F.floor(F.lit(float(repeats)) * F.col("tokens")))
        .cast("long").alias("quota"))


def _per_source(df: DataFrame) -> DataFrame:
    """A table of one row per source, ready to be joined to documents."""
    df = cut_lineage(df)
    return F.broadcast(df) if df.count() <= BROADCAST_SOURCES else df


def _crossing(parts: DataFrame, group: list[str], by: str) -> DataFrame:
    """The last part, by order of ``by`` within a source, that begins inside ``rest``;
    ``rest`` becomes what is left at its beginning."""
    w = Window.partitionBy("source").orderBy(by)
    before = F.sum("tokens").over(w) - F.col("tokens")
    keep = parts.withColumn("before", before).where("before <= rest")
    last = keep.withColumn("at", F.row_number().over(
        Window.partitionBy("source").orderBy(F.col(by).desc()))).where("at = 1")
    return last.select(*group, by, (F.col("rest") - F.col("before")).alias("rest"))


def plan_mixture(docs: DataFrame, seed: str = SEED, entropy: float = ENTROPY,
                 repeats: float = REPEATS, budget: int | None = None) -> DataFrame:
    """source, alpha, weight, quota, passes (whole ones), cut (last place of the partial pass).

    The budget defaults to the corpus' own number of tokens.
    """
    slim = docs.select(F.col("source").cast("string").alias("source"), n_tokens().alias("tokens"),
                       doc_key().alias("_key"))
    path = os.path.join(scratch_path(docs.sparkSession, f"mix-{uuid.uuid4().hex}"), "slim")
    slim.write.parquet(path)
    slim = docs.sparkSession.read.parquet(path)
    plan = weights(slim.groupBy("source").agg(F.sum("tokens").alias("tokens")),
                   entropy, repeats, budget).select(
        F.col("source").alias("src"), "alpha", "weight", "quota",
        F.expr("quota div tokens").alias("passes"), F.expr("quota % tokens").alias("rest"))
    p = place(F.col("passes"), seed)
    plan = _per_source(plan)
    placed = slim.join(plan, slim.source.eqNullSafe(plan.src)).select(
        "source", "tokens", "rest", p.alias("place"))
    placed = placed.withColumn("block", F.substring("place", 1, 3)).withColumn(
        "sub", F.substring("place", 4, 3))

    def sums(df, by):
        return df.groupBy("source", "rest", *by).agg(F.sum("tokens").alias("tokens"))

    def inside(df, cross, by):
        c = _per_source(cross).select(F.col("source").alias("s"), *(F.col(x).alias(f"_{x}") for x in by),
                         F.col("rest").alias("left"))
        on = df.source.eqNullSafe(c.s)
        for x in by:
            on = on & (df[x] == c[f"_{x}"])
        return df.join(c, on).withColumn("rest", F.col("left")).select(df.columns)

    # windows below order at most 4096 blocks, 4096 sub-blocks, one sub-block's places
    b1 = _crossing(sums(placed, ["block"]), ["source"], "block")
    in1 = inside(placed, b1, ["block"])
    b2 = _crossing(sums(in1, ["block", "sub"]), ["source", "block"], "sub")
    in2 = sums(inside(in1, b2, ["block", "sub"]), ["block", "sub", "place"])
    run = F.sum("tokens").over(Window.partitionBy("source").orderBy("place"))
    fits = in2.withColumn("run", run).where("run <= rest").groupBy("source").agg(
        F.max("place").alias("fit"))
    # nothing of the last sub-block may fit: the cut is then its beginning
    begin = b2.select(F.col("source").alias("s"), F.concat("block", "sub").alias("begin"))
    cut = begin.join(fits, F.col("s").eqNullSafe(F.col("source")), "left").select(
        "s", F.coalesce("fit", "begin").alias("cut"))
    return plan.join(cut, F.col("src").eqNullSafe(F.col("s")), "left").select(
        F.col("src").alias("source"), "alpha", "weight", "quota", "passes",
        F.coalesce("cut", F.lit("")).alias("cut"))


def mix(docs: DataFrame, seed: str = SEED, entropy: float = ENTROPY, repeats: float = REPEATS,
        budget: int | None = None) -> DataFrame:
    """The documents once per pass that takes them, with n_tokens, epoch and block."""
    plan = _per_source(plan_mixture(docs, seed, entropy, repeats, budget).select(
        F.col("source").alias("src"), "passes", "cut"))
    keep = [c for c in docs.columns if c not in ("n_tokens", "epoch", "block")]
    # all other columns in one struct, where no name can clash
    d = docs.select(F.struct(*(F.col(f"`{c}`") for c in keep)).alias("row"),
                    F.col("source").cast("string").alias("source"), n_tokens().alias("n_tokens"),
                    doc_key().alias("_key"))
    d = d.join(plan, F.col("source").eqNullSafe(F.col("src"))).withColumn(
        "epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("passes")))).withColumn(
        "place", place(F.col("epoch"), seed))
    return d.where("epoch < passes or place <= cut").select(
        "row.*", "n_tokens", "epoch",
        F.conv(F.substring("place", 1, 3), 16, 10).cast("int").alias("block"))


def _oracle(table: str, seed: str = SEED, entropy: float = ENTROPY, repeats: float = REPEATS) -> str:
    h = ("(ln(list_sum([pow(x, {m}) for x in xs])) - {m} * list_sum([pow(x, {m}) * ln(x) for x in xs])"
         " / list_sum([pow(x, {m}) for x in xs]))")
    rep = "(pow(xs[1], {m}) / list_sum([pow(x, {m}) for x in xs]) * total / (xs[1] * total))"
    goal, mid = f"{entropy}::double * ln(len(xs)::double)", "((lo + hi) / 2)"
    key = "coalesce(doc_id::varchar, '') || '|' || coalesce(md5(text), '')"
    return f"""
with recursive t as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::bigint as n_tokens,
         {key} as k from {table}
), s as (
  select source, sum(n_tokens)::bigint as tokens from t group by source having sum(n_tokens) > 0
), a as (
  select total, list_sort([y / total::double for y in ys]) as xs
  from (select list(tokens) as ys, sum(tokens)::bigint as total from s)
), e as (
  select 0 as i, xs, 0::double as lo, 1::double as hi from a
  union all
  select i + 1, xs, case when {h.format(m=mid)} >= {goal} then {mid} else lo end,
         case when {h.format(m=mid)} >= {goal} then hi else {mid} end from e where i < {STEPS}
), r as (
  select 0 as i, xs, total, 0::double as lo, 1::double as hi from a
  union all
  select i + 1, xs, total, case when {rep.format(m=mid)} > {repeats} then {mid} else lo end,
         case when {rep.format(m=mid)} > {repeats} then hi else {mid} end from r where i < {STEPS}
), al as (
  select greatest(
    (select case when {h.format(m='1::double')} >= {goal} then 1 else lo end from e where i = {STEPS}),
    (select case when {rep.format(m='0::double')} <= {repeats} then 0 else hi end from r where i = {STEPS}))
    as alpha
), q as (
  select source, tokens, floor(pow(tokens / total::double, alpha)
           / list_sum([pow(x, alpha) for x in xs]) * total + 0.5)::bigint as quota
  from s, a, al
), p as (
  select source, quota // tokens as passes, quota % tokens as rest from q
), last as (
  select t.*, passes as epoch, rest, md5('{seed}' || '|' || passes || '|' || k) as place
  from t join p on t.source is not distinct from p.source
), part as (
  select *, sum(n_tokens) over (partition by source order by place range unbounded preceding) as run
  from last
), rows as (
  select doc_id, source, n_tokens, epoch, place from part where run <= rest
  union all
  select doc_id, t.source, n_tokens, g.epoch, md5('{seed}' || '|' || g.epoch || '|' || k)
  from t join p on t.source is not distinct from p.source, lateral (
    select unnest(range(0, passes)) as epoch) g
)
select doc_id, source, n_tokens, epoch::bigint as epoch,
       ('0x' || substr(place, 1, 3))::int as block
from rows
"""


ORACLE_SQL = _oracle("documents")
