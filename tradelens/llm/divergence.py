"""Source divergence audit with iceberg prefix refinement of the vocabulary.

Terms are runs of letters and non-ASCII characters, A-Z lowered. Each language keeps the
terms that occur in at least ``min_docs`` of its documents; every source of the language
then has a smoothed share p of each kept term, and sources are compared with each other
and with their language by the floored squared difference (p - q)^2 / q.

*Refinement.* The kept terms are found by extending byte prefixes level by level, to
4, 16, 64, ... bytes. A level counts, by language, the distinct documents that hold a
term beginning with each prefix whose shorter prefix survived; a term shorter than the level counts as
complete. Prefixes in fewer than ``min_docs`` documents are discarded, since no term that
begins with one can reach the threshold; when no incomplete prefix is left, the complete
ones are counted once more as strings, by source. Rare terms (names, numbers written as letters,
noise) thus fall out while short and never meet a shuffle as strings.

Scale: a level is one scan of the texts, counted within tasks first (``HELD`` counts at a
time), so a language or word that fills a third of the corpus is no hot key.
Survivors go to the next level's tasks as a bitmap of bounded size (``bitmap.py``); a chance
hit there, or a collision of the 64-bit prefix hashes, only lets a prefix live on, and the
last count is made on the terms themselves, in one exchange by term. The comparison of
sources runs over slices of the vocabulary, each a matrix of terms by blocks of sources: a slice
sends one partial sum a pair of sources and its best terms, not one row a term and pair. The number of levels follows the longest
term that ``min_docs`` documents share, fourfold each time.

All arithmetic is in whole numbers (Python integers where a long may not hold them), the sums
of values leave as decimal(38,0).

Defined cases: null text, lang or source count as empty; every row is a document, also one
that repeats; a group without terms has count 0 for every term; a language without kept terms
has value 0 for every pair; a language with one source has no pairs; an empty table gives
no rows; extra columns are ignored; texts and terms of any length are counted whole.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, scratch_path
from .bitmap import bits_for, collect_bitmap, contains
from .packed import run_starts, shuffle_partitions
from .textscan import LOWER, byte_sums, join_hash, runs, span_hash, spans, sums_hash

MIN_DOCS, TOP_TERMS = 3, 200
FIRST_LEVEL, GROWTH = 4, 4
UNIT = 1_000_000_000
SLICE_ROWS, SOURCE_BLOCK = 200_000, 256
TASK_ROWS = 500_000
HELD = 1 << 19      # counts that a task holds at most
RUN_BYTES = 1 << 21
CELLS = 1 << 21     # cells of one matrix of terms x sources

# everything but a-z and non-ASCII (applied after lower-casing A-Z)
NON_LETTER = np.ones(256, bool)
NON_LETTER[0x61:0x7B] = False
NON_LETTER[0x80:] = False


def _language_hash(langs: list[str]) -> np.ndarray:
    raw = [v.encode() for v in langs]
    buf = np.frombuffer(b"".join(raw), np.uint8)
    end = np.cumsum([len(v) for v in raw])
    return span_hash(buf, end - [len(v) for v in raw], end)


class Words:
    """The words of one run of texts with what names their prefixes: language and bytes.
    Hashing begins with the first prefix, over the bytes of the words left by then."""

    def __init__(self, batch, first: int, buf: np.ndarray, off: np.ndarray):
        self.buf = LOWER[buf]
        self.start, self.end, count = spans(self.buf, off, NON_LETTER)
        self.row = np.repeat(np.arange(len(off) - 1), np.diff(count))
        langs = batch.column("lang").slice(first, len(off) - 1).to_pylist()
        known = {v: i for i, v in enumerate(sorted(set(langs)))}
        self.langs = list(known)
        self.lang = np.array([known[v] for v in langs], np.int64)
        self.seeds = _language_hash(self.langs)[self.lang]
        self.sums = None

    def keep(self, which: np.ndarray) -> None:
        self.start, self.end, self.row = self.start[which], self.end[which], self.row[which]

    def pack(self) -> None:
        """Leaves the bytes of the words alone, one after the other."""
        size = self.end - self.start
        end = np.cumsum(size)
        self.buf = self.buf[np.repeat(self.start - (end - size), size) + np.arange(size.sum())]
        self.start, self.end = end - size, end

    def prefix(self, level: int, which=slice(None)) -> np.ndarray:
        """Hash of language and the first ``level`` bytes of every word. A complete word
        is shorter than the level, so its span's length tells it from a prefix."""
        if self.sums is None:
            self.sums = byte_sums(self.buf)
        start = self.start[which]
        return join_hash(self.seeds[self.row[which]], sums_hash(
            self.sums, start, np.minimum(self.end[which], start + level)))

    def alive(self, survivors: list[tuple[int, np.ndarray]]) -> None:
        """Leaves the words that were longer than the last level and whose prefix survived it."""
        if survivors:
            level, bitmap = survivors[-1]
            n = len(self.start)
            self.keep(self.end - self.start >= level)
            if 4 * len(self.start) < n:
                self.pack()
            self.keep(contains(bitmap, self.prefix(level)))

    def complete(self, survivors: list[tuple[int, np.ndarray]]) -> None:
        """Leaves the words that survived the level at which they were complete."""
        size, kept, low = self.end - self.start, np.zeros(len(self.start), bool), 0
        for level, bitmap in survivors:
            at = np.flatnonzero((size >= low) & (size < level))
            kept[at] = contains(bitmap, self.prefix(level, at))
            low = level
        self.keep(kept)

    def codes(self) -> tuple[pa.Array, np.ndarray]:
        """The distinct words and the number of each word's, compared as bytes."""
        self.pack()
        off = np.append(self.start, self.end[-1:])
        words = pa.LargeStringArray.from_buffers(
            len(self.start), pa.py_buffer(off.astype(np.int64)), pa.py_buffer(self.buf))
        coded = words.dictionary_encode()
        return coded.dictionary, coded.indices.to_numpy()


def added(held: list[pa.RecordBatch], keys: list[str], sums: list[str]) -> pa.Table:
    """Rows of equal ``keys`` as one row each."""
    t = pa.Table.from_batches(held).group_by(keys, use_threads=False).aggregate(
        [(c, "sum") for c in sums])
    return t.rename_columns([c.removesuffix("_sum") for c in t.column_names]).select(keys + sums)


def merged(batches, keys: list[str], sums: list[str], whole: bool = False):
    """Rows of equal ``keys`` added up within the task: ``HELD`` rows at a time, or all of the
    task's (``whole``), holding its distinct keys and ``HELD`` rows more."""
    held, n, done = [], 0, 0
    for b in batches:
        held.append(b.select(keys + sums))
        n += b.num_rows
        if n - done >= HELD:
            t = added(held, keys, sums)
            held, n = t.to_batches(), t.num_rows
            done = n if whole else 0
            if not whole and n > HELD // 2:
                yield from held
                held, n = [], 0
    if held:
        yield from added(held, keys, sums).to_batches()


def _prefix_counts(level: int, held):
    def rows(batches):
        for b in batches:
            for first, buf, off in runs(b.column("text"), RUN_BYTES):
                w = Words(b, first, buf, off)
                w.alive(held.value)
                if not len(w.start):
                    continue
                h, open_ = w.prefix(level), w.end - w.start >= level
                order = np.argsort(h)
                h = h[order]
                at = run_starts(h)
                number = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(h))))
                n = len(off)
                pair = np.sort(number * n + w.row[order])
                pair = pair[run_starts(pair)]        # a prefix once a document
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[at].view(np.int64)), pa.array(open_[order[at]]),
                     pa.array(np.bincount(pair // n, minlength=len(at)))], names=["h", "open", "docs"])

    return lambda batches: merged(rows(batches), ["h", "open"], ["docs"])


def _term_counts(held):
    """The complete terms that survived, with their counts by source (``KEPT``)."""
    def rows(batches):
        for b in batches:
            for first, buf, off in runs(b.column("text"), RUN_BYTES):
                w = Words(b, first, buf, off)
                w.complete(held.value)
                if not len(w.start):
                    continue
                terms, code = w.codes()
                source = b.column("h").to_numpy()[first:first + len(off) - 1]
                known, source = np.unique(source, return_inverse=True)
                group = w.lang * len(known) + source
                key = np.sort((group[w.row] * len(terms) + code) * len(off) + w.row)
                once = run_starts(key)                   # a term once a document
                term = key // len(off)
                at, first_docs = run_starts(term), run_starts(term[once])
                group, code = term[at] // len(terms), term[at] % len(terms)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(w.langs).take(pa.array(group // len(known))),
                     terms.take(pa.array(code)).cast(pa.string()),
                     pa.array(known[group % len(known)]),
                     pa.array(np.diff(np.append(at, len(term)))),
                     pa.array(np.diff(np.append(first_docs, len(once))))],
                    names=["lang", "term", "h", "n", "docs"])

    def packed(batches):
        for b in merged(rows(batches), ["lang", "term", "h"], ["n", "docs"]):
            yield from by_term(pa.Table.from_batches([b])).to_batches(max_chunksize=1 << 13)

    return packed


KEPT = "lang string, term string, docs long, lang_n long, counts binary"


def by_term(t: pa.Table) -> pa.Table:
    """One row a term: documents, occurrences, and (source hash, occurrences) of each
    source in ``counts``. The exchange has a row a term, not one a term and source."""
    t = t.group_by(["lang", "term"], use_threads=False).aggregate(
        [("docs", "sum"), ("n", "sum"), ("h", "list"), ("n", "list")]).combine_chunks()
    h, n = (t.column(c).combine_chunks() for c in ("h_list", "n_list"))
    pairs = np.column_stack([h.flatten().to_numpy(), n.flatten().to_numpy()])
    ends = h.offsets.to_numpy().astype(np.int64) * 16
    counts = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(h), [None, pa.py_buffer(ends), pa.py_buffer(pairs.tobytes())])
    return pa.table({"lang": t.column("lang"), "term": t.column("term"), "docs": t.column("docs_sum"),
                     "lang_n": t.column("n_sum"), "counts": counts.cast(pa.binary())})


def by_source(t) -> pa.Table:
    """One row a term and source again; a term's documents stand in its first row."""
    counts = t.column("counts")
    if isinstance(counts, pa.ChunkedArray):
        counts = counts.combine_chunks()
    size = pa.compute.binary_length(counts).to_numpy() // 16
    pairs = np.frombuffer(b"".join(counts.to_pylist()), np.int64).reshape(-1, 2)
    row = np.repeat(np.arange(len(size)), size)
    docs = np.zeros(len(row), np.int64)
    docs[run_starts(row)] = t.column("docs").to_numpy()
    return pa.table({c: t.column(c).take(pa.array(row)) for c in ("lang", "term", "lang_n")} | {
        "h": np.ascontiguousarray(pairs[:, 0]), "n": np.ascontiguousarray(pairs[:, 1]), "docs": docs})


def _frequent(min_docs: int):
    """The counts of a task's terms (all rows of a term are in one task), added up; the
    terms in enough documents."""
    def run(batches):
        flat = (x for b in batches if b.num_rows for x in by_source(b).to_batches())
        held = list(merged(flat, ["lang", "term", "h"], ["n", "docs"], whole=True))
        if held:
            t = by_term(pa.Table.from_batches(held))
            yield from t.filter(pa.compute.greater_equal(t["docs"], min_docs)).to_batches(
                max_chunksize=1 << 13)
    return run


def _totals(batches):
    """Occurrences by language and source."""
    def rows():
        for b in batches:
            if b.num_rows:
                yield from by_source(b).to_batches()

    return merged(rows(), ["lang", "h"], ["n"], whole=True)


def with_hashes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """text, lang, source (null as empty) and a hash h of the source; and the groups
    (lang, source, h), in each language of which the hashes differ."""
    docs = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
                         for c in ("text", "lang", "source")])
    groups = cut_lineage(docs.select("lang", "source").distinct())
    seed, n = 0, groups.count()
    while groups.select("lang", F.xxhash64("source", F.lit(seed))).distinct().count() < n:
        seed += 1
    h = F.xxhash64("source", F.lit(seed)).alias("h")
    return docs.select("*", h), groups.select("*", h)


def refine(docs: DataFrame, min_docs: int = MIN_DOCS) -> tuple[list[tuple[int, np.ndarray]], int]:
    """Level by level, the bitmap of the prefixes (complete terms among them) in at least
    ``min_docs`` documents of their language; and the number of complete ones."""
    spark = docs.sparkSession
    survivors: list[tuple[int, np.ndarray]] = []
    level, left, complete = FIRST_LEVEL, 1, 0
    while left:
        held = spark.sparkContext.broadcast(survivors)
        found = cut_lineage(docs.select("lang", "text").mapInArrow(
            _prefix_counts(level, held), "h long, open boolean, docs long")
            .groupBy("h", "open").agg(F.sum("docs").alias("docs"))
            .where(F.col("docs") >= min_docs).select("h", "open"))
        n, left = found.agg(F.count("*"), F.count_if("open")).first()
        complete += n - left
        survivors.append((level, collect_bitmap(found, F.col("h"), bits_for(n))))
        level *= GROWTH
    return survivors, complete


def kept_terms(docs: DataFrame, groups: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """lang, term, docs, lang_n, counts: each kept term with its documents and occurrences in
    the language and its occurrences in each source (``docs``, ``groups``: ``with_hashes``)."""
    spark = docs.sparkSession
    survivors, complete = refine(docs, min_docs)
    held = spark.sparkContext.broadcast(survivors)
    most = groups.groupBy("lang").count().agg(F.max("count")).first()[0] or 0
    # a task holds the counts of its terms: so many tasks that these stay small
    tasks = max(shuffle_partitions(spark), -(-complete * most // TASK_ROWS))
    path = scratch_path(spark, f"terms-{uuid.uuid4().hex}")
    docs.select("lang", "text", "h").mapInArrow(_term_counts(held), KEPT) \
        .repartition(tasks, "lang", "term").mapInArrow(_frequent(min_docs), KEPT) \
        .write.parquet(path)
    return spark.read.schema(KEPT).parquet(path)


def _shares(count: np.ndarray, total: np.ndarray, terms: int) -> np.ndarray:
    """1 + floor(10^9 (count + 1) / (total + terms)), in Python integers where a product may
    leave int64."""
    kind = np.int64 if int(count.max(initial=0)) < 2**63 // UNIT - 1 else object
    return (UNIT * (count.astype(kind) + 1) // (total.astype(kind) + terms) + 1).astype(np.int64)


def _squared(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / q); p and q are at most 10^9 + 1, their square fits int64."""
    return (p - q) ** 2 // q


OUT = "lang string, source string, part string, item string, f long"


def _compared(top: int):
    """For one slice of a language's terms and one block of its sources: by source of the
    block and other source, the sum of ``_squared`` over the slice; in the first block also the
    ``top`` terms of each source that it has more often than the language."""
    def run(key, rows: pa.Table, groups: pa.Table) -> pa.Table:
        part, block = key[1].as_py(), key[2].as_py()
        groups = groups.sort_by("i")
        names, total = groups.column("source").combine_chunks(), groups.column("total").to_numpy()
        own = np.flatnonzero(groups.column("i").to_numpy() // SOURCE_BLOCK == block)
        sums = np.zeros((len(own), len(names)), np.int64)
        best = pa.table({"source": pa.array([], pa.string()), "item": pa.array([], pa.string()),
                         "f": pa.array([], pa.int64())})
        if rows.num_rows:
            terms = groups.column("terms")[0].as_py()
            rows = by_source(rows).sort_by("term")
            term = rows.column("term").combine_chunks()
            code = term.dictionary_encode().indices.to_numpy()
            count = rows.column("n").to_numpy()
            source = pa.compute.index_in(rows.column("h"), groups.column("h").combine_chunks()).to_numpy()
            p = _shares(count, total[source], terms)
            unseen = _shares(np.zeros(len(names), np.int64), total, terms)
            step = max(1, CELLS // len(names))
            for low in range(0, int(code[-1]) + 1, step):
                x, y = np.searchsorted(code, [low, low + step])
                dense = np.tile(unseen, (int(code[y - 1]) + 1 - low, 1))
                dense[code[x:y] - low, source[x:y]] = p[x:y]
                for k, a in enumerate(own):
                    sums[k] += _squared(dense[:, a:a + 1], dense).sum(axis=0)
            if block == 0:
                q = _shares(rows.column("lang_n").to_numpy(), np.array([sum(total.tolist())]), terms)
                more = np.flatnonzero(p > q)
                f = _squared(p[more], q[more])
                order = np.lexsort((code[more], -f, source[more]))    # terms are in byte order
                s = source[more][order]
                first = run_starts(s)
                place = np.arange(len(s)) - np.repeat(first, np.diff(np.append(first, len(s))))
                pick = order[place < top]
                best = pa.table({"source": names.take(pa.array(source[more][pick])),
                                 "item": term.take(pa.array(more[pick])), "f": f[pick]})
        elif part:
            own, sums = own[:0], sums[:0]        # slice 0 speaks for a language without terms
        a, b = np.nonzero(own[:, None] != np.arange(len(names)))
        pairs = pa.table({"source": names.take(pa.array(own[a], pa.int64())),
                          "item": names.take(pa.array(b, pa.int64())), "f": sums[a, b]})
        kind = ["pair"] * pairs.num_rows + ["term"] * best.num_rows
        both = pa.concat_tables([pairs, best])
        return both.add_column(0, "lang", pa.array([key[0].as_py()] * len(kind), pa.string())) \
            .add_column(2, "part", pa.array(kind, pa.string()))
    return run


def source_groups(groups: DataFrame, terms: DataFrame) -> DataFrame:
    """lang, source, h, i (number in the language), total (N), terms (V) of every group."""
    own = terms.mapInArrow(_totals, "lang string, h long, n long").groupBy("lang", "h").agg(
        F.sum("n").alias("total"))
    vocabulary = terms.groupBy("lang").agg(F.count("*").alias("terms"))
    return groups.join(own, ["lang", "h"], "left").join(vocabulary, "lang", "left").select(
        "lang", "source", "h",
        (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).alias("i"),
        F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("terms", F.lit(0)).alias("terms"))


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """lang, source, part (pair, term), item, value, rank: how far each source of a language is
    from each other one, and its ``top_terms`` most over-represented terms."""
    docs, groups = with_hashes(docs)
    terms = kept_terms(docs, groups, min_docs)
    groups = cut_lineage(source_groups(groups, terms))
    blocks = (groups.agg(F.max("i")).first()[0] or 0) // SOURCE_BLOCK + 1
    rows = (terms.agg(F.sum(F.octet_length("counts"))).first()[0] or 0) // 16
    slices = -(-rows // SLICE_ROWS) or 1

    def every(n):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = terms.withColumn("slice", F.pmod(F.xxhash64("term"), F.lit(slices)).cast("int")) \
        .withColumn("block", every(blocks))
    right = groups.withColumn("slice", every(slices)).withColumn("block", every(blocks))
    keys = ("lang", "slice", "block")
    parts = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_compared(top_terms), OUT)
    # a term is in one slice, a pair in all
    values = parts.groupBy("lang", "source", "part", "item").agg(
        F.sum(F.col("f").cast("decimal(28,0)")).cast("decimal(38,0)").alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    return values.withColumn("rank", F.row_number().over(order)).where(
        (F.col("part") == "pair") | (F.col("rank") <= top_terms)).select(
        "lang", "source", "part", "item", "value", "rank")


ORACLE_SQL = """
with docs as (select row_number() over () as id, coalesce(text, '') as text,
    coalesce(lang, '') as lang, coalesce(source, '') as source from documents),
words as (select id, lang, source, unnest(regexp_extract_all(translate(text,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term from docs),
kept as (select lang, term, count(*) as n from words group by all having count(distinct id) >= 3),
size as (select lang, count(*)::hugeint as v, sum(n)::hugeint as n from kept group by lang),
groups as (select distinct lang, source from docs),
counts as (select lang, source, term, count(*)::hugeint as n from words
    join kept using (lang, term) group by all),
totals as (select lang, source, coalesce(sum(n), 0)::hugeint as n from groups
    left join counts using (lang, source) group by all),
shares as (select g.lang, g.source, k.term, coalesce(c.n, 0) as n,
    1 + 1000000000::hugeint * (coalesce(c.n, 0) + 1) // (t.n + s.v) as p
    from groups g join kept k using (lang) join size s using (lang)
    join totals t using (lang, source) left join counts c using (lang, source, term)),
pairs as (select a.lang, a.source, b.source as item,
    sum((a.p - b.p) * (a.p - b.p) // b.p) as value
    from shares a join shares b using (lang, term) where a.source <> b.source group by all),
both_parts as (select a.lang, a.source, 'pair' as part, b.source as item,
    coalesce(p.value, 0)::bigint as value from groups a join groups b using (lang)
    left join pairs p on p.lang = a.lang and p.source = a.source and p.item = b.source
    where a.source <> b.source
  union all select lang, source, 'term', term, ((p - q) * (p - q) // q)::bigint from (
    select x.*, 1 + 1000000000::hugeint * (k.n + 1) // (s.n + s.v) as q from shares x
    join kept k using (lang, term) join size s using (lang) where x.n > 0) where p > q)
select lang, source, part, item, value, rank from (select *, row_number() over (
    partition by lang, source, part order by value desc, item)::int as rank from both_parts)
where part = 'pair' or rank <= 200
"""
