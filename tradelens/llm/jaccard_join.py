"""N-gram Jaccard join with a token-group matrix.

A document's set holds its distinct ``width``-word shingles (words of ASCII
white space, A-Z lowered; a shorter text is one shingle). Two documents link
when 100 * |A & B| >= 75 * |A | B|. A partner B of A covers at least 75 % of A's
shingles, so |A & U| >= 0.75 |A| for any union U of sets that holds B: the bound
every step below uses.

1. Slices report their distinct shingles in a packed exchange and learn which
   occur in more than one document (the union of all the others). A document
   below the bound has no partner and leaves with its text; for most documents
   that is the end. Equal sets become one class, with a number of its own.
2. The same count over classes prunes once more and gives every shingle's
   document frequency.
3. Classes are partitioned into groups of similar sets: equal smallest hash
   (likely for similar sets), hot groups split into parts of about ``part``
   classes. Each group links its members and checks them against the hub
   (smallest class) of the split group; linked classes get one label.
4. Token-group matrix: each token of a class's rarest (|A| - ceil(0.75|A|) + 1)
   tokens lists the groups that hold it. A class is a query for a group it
   shares such a token with if the group has a member of another, larger label:
   within one label nothing is left to find, so a dense group of K near copies
   costs about its unlinked members times its parts, not K * K.
   A group gets its queries' sets, bounds them by its token union, and only the
   qualifying ones are compared with its members, exactly.
5. Labels joined by links are contracted to components.

Nothing is capped: groups are split, queries of a group are dealt in blocks.

Defined cases: null or blank text has an empty set and links with nothing; a
row with a null ``doc_id`` links with nothing and has a null component; every row is
judged by its own text, so rows that repeat share a class and a ``doc_id`` with two texts has two
sets (``doc_id`` only names the result); texts of any length are read whole; extra columns are
ignored; an empty table gives no rows.
Sets are compared through 64-bit shingle hashes.
"""

from __future__ import annotations

import hashlib
import os
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, scratch_path
from . import packed as P
from .textscan import LOWER, SPACE, runs, span_hash, spans, window_hash

SETS = "doc_id long, n_shingles long, text_md5 binary, sig binary, tokens binary"
SETS_ARROW = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("text_md5", pa.binary()),
                        ("sig", pa.binary()), ("tokens", pa.binary())])
CLASS = "class long, tokens binary, prefix binary, mh long"
CLASS_ARROW = pa.schema([("class", pa.int64()), ("tokens", pa.binary()), ("prefix", pa.binary()),
                         ("mh", pa.int64())])
NUM, DEN = 75, 100     # link threshold, in hundredths


def shingle_sets(texts, width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text."""
    out = []
    for _, buf, off in runs(texts):
        buf = LOWER[buf]
        s, e, w = spans(buf, off, SPACE)
        h = span_hash(buf, s, e)
        win = window_hash(h, width)
        for x, y in zip(w[:-1], w[1:]):
            if y - x >= width:
                u = np.sort(win[x:y - width + 1])
                out.append(u[P.run_starts(u)])
            else:
                out.append(window_hash(h[x:y], int(y - x), seed=int(y - x)) if y > x else h[:0])
    return out


def _flat(sets):
    n = np.array([len(x) for x in sets], np.int64)
    return (np.concatenate(sets) if len(sets) else np.zeros(0, np.uint64),
            np.repeat(np.arange(len(sets)), n), n)


def _entries(h, row):
    order = np.argsort(h)
    first = P.run_starts(h[order])
    return order, first, np.diff(np.append(first, len(h)))


def _send(h, size, me, buckets):
    """One row per bucket: 32 bits of each distinct hash and its count in the slice."""
    low, cut = h.astype(np.uint32), P.bounds(h, buckets)
    return P.rows([(k, me, P.ENTRIES, int(y - x), low[x:y].tobytes(),
                    P.pack_bits(size[x:y] > 1),
                    np.repeat(size[x:y], size[x:y] > 1).astype(np.uint32).tobytes())
                   for k, (x, y) in enumerate(zip(cut[:-1], cut[1:])) if y > x])


def _counts(rs):
    size = np.ones(sum(r["n"] for r in rs), np.int64)
    many = np.concatenate([P.unpack_bits(r["b"], r["n"]) for r in rs])
    size[many] = np.concatenate([np.frombuffer(r["c"], np.uint32) for r in rs])
    return size


def _doc_pass(buckets, width):
    def run(key, t):
        t = t.filter(pa.compute.is_valid(t.column("doc_id")))
        h, row, _ = _flat(shingle_sets(t.column("text"), width))
        order, first, size = _entries(h, row)
        return _send(h[order][first], size, key[0].as_py(), buckets)
    return run


def _matcher(levels: bool):
    """Answers each entry: shared at all (a bit), or the level of its frequency (a byte)."""
    def run(key, t):
        rs = t.to_pylist()
        h, size = np.concatenate([np.frombuffer(r["a"], np.uint32) for r in rs]), _counts(rs)
        order = np.argsort(h)
        first = P.run_starts(h[order])
        total = np.add.reduceat(size[order], first)
        got = np.floor(8 * np.log2(total)).astype(np.uint8) if levels else total > 1
        out = np.empty(len(h), got.dtype)
        out[order] = np.repeat(got, np.diff(np.append(first, len(h))))
        cut = np.cumsum([0] + [r["n"] for r in rs])
        return P.rows([(r["bucket"], r["slice"], P.ENTRIES, r["n"],
                        out[x:y].tobytes() if levels else P.pack_bits(out[x:y]), None, None)
                       for r, x, y in zip(rs, cut[:-1], cut[1:])])
    return run


def _set_pass(width):
    def run(key, t, got):
        if not t.num_rows:
            return SETS_ARROW.empty_table()
        valid = t.column("doc_id").is_valid().to_numpy()
        sets = shingle_sets(t.column("text"), width)
        h, row, n = _flat([x if v else x[:0] for x, v in zip(sets, valid)])
        shared = np.zeros(len(h), bool)
        if (bits := P.answers(got)) is not None:
            order, _, size = _entries(h, row)
            shared[order] = np.repeat(bits, size)
        common = np.bincount(row[shared], minlength=len(sets))
        live = (common * DEN >= n * NUM) & (n > 0)
        return pa.Table.from_arrays([
            t.column("doc_id").combine_chunks(), pa.array([len(x) for x in sets], pa.int64()),
            pa.array([hashlib.md5((x or "").encode()).digest() for x in t.column("text").to_pylist()],
                     pa.binary()),
            pa.array([hashlib.blake2b(x.tobytes(), digest_size=16).digest() if k else None
                      for x, k in zip(sets, live)], pa.binary()),
            pa.array([x.tobytes() if k else None for x, k in zip(sets, live)], pa.binary()),
        ], schema=SETS_ARROW)
    return run


def _class_sets(t):
    t = t.sort_by("class")
    return t.column("class").to_numpy(), [np.frombuffer(x.as_py(), np.uint64)
                                          for x in t.column("tokens")]


def _class_pass(buckets):
    def run(key, t):
        h, row, _ = _flat(_class_sets(t)[1])
        order, first, size = _entries(h, row)
        return _send(h[order][first], size, key[0].as_py(), buckets)
    return run


def _prefix_pass(key, t, got):
    """Classes that keep the bound, with their rarest tokens that others hold too."""
    if not t.num_rows:
        return CLASS_ARROW.empty_table()
    cls, sets = _class_sets(t)
    h, row, n = _flat(sets)
    order, _, size = _entries(h, row)
    level = np.empty(len(h), np.uint8)
    level[order] = np.repeat(np.concatenate([np.frombuffer(x, np.uint8) for _, x in sorted(
        (r["bucket"], r["a"]) for r in got.select(["bucket", "a"]).to_pylist())]), size)
    off, out = np.concatenate([[0], np.cumsum(n)]), []
    for i, x in enumerate(sets):
        lv = level[off[i]:off[i + 1]]
        if (lv > 0).sum() * DEN >= len(x) * NUM:
            rare = np.lexsort((x, lv))[:len(x) - -(-len(x) * NUM // DEN) + 1]
            out.append((int(cls[i]), x.tobytes(), x[rare[lv[rare] > 0]].tobytes(),
                        int(x[0].view(np.int64))))
    return pa.Table.from_pylist([dict(zip(CLASS_ARROW.names, r)) for r in out], schema=CLASS_ARROW)


def _links(sets_a, sets_b):
    """Boolean link matrix between two lists of sets, within their common tokens."""
    ha, ra, na = _flat(sets_a)
    hb, rb, nb = _flat(sets_b)
    vocab = np.intersect1d(ha, hb)
    both = np.zeros((len(sets_a), len(sets_b)), np.float32)
    ia, ib = np.searchsorted(vocab, ha), np.searchsorted(vocab, hb)
    for lo in range(0, len(vocab), 4096):
        m = []
        for i, h, r, rows in ((ia, ha, ra, len(sets_a)), (ib, hb, rb, len(sets_b))):
            k = np.flatnonzero((i >= lo) & (i < min(lo + 4096, len(vocab))))
            k = k[vocab[i[k]] == h[k]]
            x = np.zeros((rows, 4096), np.float32)
            x[r[k], i[k] - lo] = 1
            m.append(x)
        both += m[0] @ m[1].T
    both = both.astype(np.int64)
    return (DEN * both >= NUM * (na[:, None] + nb[None] - both)) & (both > 0)


LABELS_ARROW = pa.schema([("class", pa.int64()), ("gid", pa.int64()), ("label", pa.int64())])


def _group_pass(key, t):
    """Links inside one group and with its hub; one label per linked part."""
    t = t.sort_by([("class", "ascending"), ("hub", "ascending")])
    cls, sets = t.column("class").to_numpy(), [np.frombuffer(x.as_py(), np.uint64)
                                               for x in t.column("tokens")]
    hub = t.column("hub").to_numpy(zero_copy_only=False)
    label = np.arange(len(cls))
    if len(cls) > 1:
        adj = _links(sets, sets)
        while True:
            new = np.where(adj, label[None], len(cls)).min(1)
            new = np.minimum(new, label)
            if (new == label).all():
                break
            label = new
    own = np.flatnonzero(~hub)
    # the hub is its split group's smallest class, so the smallest label wins everywhere
    return pa.Table.from_arrays([pa.array(cls[own]), pa.array(np.full(len(own), key[0].as_py())),
                                 pa.array(cls[label[own]])], schema=LABELS_ARROW)


def _matrix_pass(buckets):
    """Per bucket the prefix tokens of a slice's classes with (class, group, label rank)."""
    def run(key, t):
        pre = [np.frombuffer(x.as_py(), np.uint64) for x in t.column("prefix")]
        h, row, _ = _flat(pre)
        order = np.argsort(h)
        h, row, cut = h[order], row[order], None
        info = np.stack([t.column(c).to_numpy() for c in ("class", "gid", "label", "lsize")])
        cut, out = P.bounds(h, buckets), []
        for k, (x, y) in enumerate(zip(cut[:-1], cut[1:])):
            if y > x:
                own, at = np.unique(row[x:y], return_inverse=True)
                out.append((k, key[0].as_py(), P.ENTRIES, int(y - x), h[x:y].tobytes(),
                            info[:, own].tobytes(), at.astype(np.uint32).tobytes()))
        return P.rows(out)
    return run


QUERIES_ARROW = pa.schema([("gid", pa.int64()), ("queries", pa.binary())])


def _query_pass(key, t):
    """Groups that share a prefix token with a query whose label is smaller."""
    hs, infos, ats, base = [], [], [], 0
    for r in t.to_pylist():
        info = np.frombuffer(r["b"], np.int64).reshape(4, -1)
        hs.append(np.frombuffer(r["a"], np.uint64))
        ats.append(np.frombuffer(r["c"], np.uint32).astype(np.int64) + base)
        infos.append(info)
        base += info.shape[1]
    info, h, at = np.concatenate(infos, axis=1), np.concatenate(hs), np.concatenate(ats)
    order = np.lexsort((info[0][at], h))
    h, at = h[order], at[order]
    pairs = np.unique(info[[3, 2]].T, axis=0, return_inverse=True)[1].reshape(-1)   # label rank
    first = P.run_starts(h)
    found: dict[int, set] = {}
    seen = set()
    for x, y in zip(first, np.append(first[1:], len(h))):
        if y - x < 2:
            continue
        m = at[x:y]
        rank = pairs[m]
        if (rank == rank[0]).all() or (k := info[0][m].tobytes()) in seen:
            continue
        seen.add(k)
        gid, top = info[1][m], {}
        for g, v in zip(gid.tolist(), rank.tolist()):
            top[g] = max(v, top.get(g, -1))
        by_rank = np.argsort(rank)
        ordered, classes = rank[by_rank], info[0][m][by_rank]
        for g, v in top.items():
            if q := classes[:np.searchsorted(ordered, v)].tolist():
                found.setdefault(g, set()).update(q)
    return pa.Table.from_arrays([
        pa.array(list(found), pa.int64()),
        pa.array([np.array(sorted(q), np.int64).tobytes() for q in found.values()], pa.binary())],
        schema=QUERIES_ARROW)


ASKS_ARROW = pa.schema([("gid", pa.int64()), ("block", pa.int64()), ("class", pa.int64())])


def _ask_pass(block):
    def run(key, t):
        q = np.unique(np.concatenate([np.frombuffer(x.as_py(), np.int64)
                                      for x in t.column("queries")]))
        return pa.Table.from_arrays([pa.array(np.full(len(q), key[0].as_py())),
                                     pa.array(np.arange(len(q)) // block), pa.array(q)],
                                    schema=ASKS_ARROW)
    return run


EDGES_ARROW = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def _open_pass(key, q, g):
    """Bound each query by the group's token union; compare the qualifying ones."""
    if not q.num_rows or not g.num_rows:
        return EDGES_ARROW.empty_table()
    members, queries = ([np.frombuffer(x.as_py(), np.uint64) for x in c]
                        for c in (g.column("tokens_of_member"), q.column("tokens")))
    union = np.unique(np.concatenate(members))
    h, row, n = _flat(queries)
    held = union[np.minimum(np.searchsorted(union, h), len(union) - 1)] == h
    keep = np.flatnonzero(np.bincount(row[held], minlength=len(n)) * DEN >= n * NUM)
    if not len(keep):
        return EDGES_ARROW.empty_table()
    i, j = np.nonzero(_links([queries[k] for k in keep], members))
    lq, lg = q.column("label").to_numpy(), g.column("label_of_member").to_numpy()
    e = np.stack([lq[keep[i]], lg[j]])
    e = np.unique(e[:, e[0] != e[1]], axis=1)
    return pa.Table.from_arrays([pa.array(e[0]), pa.array(e[1])], schema=EDGES_ARROW)


def _components(edges: DataFrame) -> DataFrame:
    """(v, root): the smallest vertex of each component, for vertices with an edge.

    Each round every vertex points to the smallest of its closed neighbourhood,
    pointers are doubled up to their ends and the graph is contracted to those
    (local minima), so rounds and doublings both grow with a logarithm.
    """
    def follow(df: DataFrame, c: str, to: DataFrame) -> DataFrame:
        to = to.select(F.col("v").alias("_v"), F.col("root").alias("_root"))
        return df.join(to, df[c] == to._v, "left").withColumn(
            c, F.coalesce("_root", c)).drop("_v", "_root")

    edges, total = cut_lineage(edges.distinct()), None
    while total is None or not edges.isEmpty():
        both = edges.select("u", "v").union(edges.select(F.col("v"), F.col("u")))
        step = cut_lineage(both.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m")).select(
            F.col("w").alias("v"), F.least("w", "m").alias("root")))
        while True:
            far = cut_lineage(follow(step.withColumn("near", F.col("root")), "root", step))
            step = far.select("v", "root")
            if far.where("root != near").isEmpty():
                break
        total = step if total is None else cut_lineage(follow(total, "root", step))
        edges = cut_lineage(follow(follow(edges, "u", step), "v", step).where("u != v").distinct())
    return total


def linked(docs: DataFrame, width: int = 5, part: int = 256, block: int = 512,
           slices: int | None = None, buckets: int | None = None) -> DataFrame:
    """doc_id, text_md5, n_shingles, component_id (smallest doc_id reachable by links) per row."""
    spark = docs.sparkSession
    slices, buckets = P.sizes(docs, slices, buckets)
    folder = scratch_path(spark, f"jaccard-{uuid.uuid4().hex}")

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(os.path.join(folder, name))
        return spark.read.parquet(os.path.join(folder, name))

    # 1. documents whose shingles others cover to 75 % or more
    d = P.with_slice(docs, slices)
    seen = d.groupBy("slice").applyInArrow(_doc_pass(buckets, width), P.ROW)
    shared = seen.groupBy("bucket").applyInArrow(_matcher(False), P.ROW)
    sets = stored(d.groupBy("slice").cogroup(shared.groupBy("slice")).applyInArrow(
        _set_pass(width), SETS), "sets")

    # 2. classes of equal sets, pruned by what other classes cover
    live = sets.where("tokens is not null")
    classes = live.groupBy("sig").agg(F.min("doc_id").alias("first_id"),
                                      F.first("tokens").alias("tokens"))
    # numbered when they are written, so the numbers hold from here on
    named = stored(classes.withColumn("class", F.monotonically_increasing_id()), "classes")
    c = named.select("class", "tokens", F.pmod(F.xxhash64("class"), F.lit(slices))
                     .cast("int").alias("slice"))
    levels = c.groupBy("slice").applyInArrow(_class_pass(buckets), P.ROW).groupBy(
        "bucket").applyInArrow(_matcher(True), P.ROW)
    cand = stored(c.groupBy("slice").cogroup(levels.groupBy("slice")).applyInArrow(
        _prefix_pass, CLASS), "candidates")

    # 3. groups of similar classes, linked inside
    many = cand.groupBy("mh").agg(F.count("*").alias("cnt"), F.min("class").alias("hub"))
    sub = F.when(F.col("cnt") > part, F.pmod(F.xxhash64("class"), F.ceil(F.col("cnt") / part))
                 ).otherwise(0)
    placed = cand.join(many, "mh").select("class", "tokens", "mh", "cnt", "hub",
                                          F.xxhash64("mh", sub).alias("gid"))
    hubs = placed.where(F.col("cnt") > part).select("gid", F.col("hub").alias("class")).distinct()
    hub_rows = hubs.join(cand.select("class", "tokens"), "class")
    grouped = placed.select("gid", "class", "tokens", F.lit(False).alias("hub")).union(
        hub_rows.select("gid", "class", "tokens", F.lit(True)))
    labels = cut_lineage(grouped.groupBy("gid").applyInArrow(
        _group_pass, "class long, gid long, label long"))

    # 4. token-group matrix: queries to the groups of other labels
    sizes = labels.groupBy("label").agg(F.count("*").alias("lsize"))
    matrix = cand.select("class", "prefix").join(labels, "class").join(sizes, "label").withColumn(
        "slice", F.pmod(F.xxhash64("class"), F.lit(slices)).cast("int"))
    asked = matrix.groupBy("slice").applyInArrow(_matrix_pass(buckets), P.ROW).groupBy(
        "bucket").applyInArrow(_query_pass, "gid long, queries binary")
    asks = cut_lineage(asked.groupBy("gid").applyInArrow(
        _ask_pass(block), "gid long, block long, class long"))
    full = cand.select("class", "tokens").join(labels, "class")
    q = asks.join(full.drop("gid"), "class")
    g = asks.select("gid", "block").distinct().join(full, "gid").select(
        *(F.col(c).alias(f"{c}_of_member") for c in ("gid", "block", "tokens", "label")))
    links = q.groupBy("gid", "block").cogroup(
        g.groupBy("gid_of_member", "block_of_member")).applyInArrow(
        _open_pass, "u long, v long")

    # 5. components of labels, and back to documents
    roots = _components(links)
    comp = labels.join(roots, labels.label == roots.v, "left").select(
        F.col("class"), F.coalesce("root", "label").alias("component"))
    whole = named.select("sig", "first_id", "class").join(comp, "class", "left").select(
        F.col("sig").alias("s"), "first_id", F.coalesce("component", "class").alias("component"))
    smallest = whole.groupBy("component").agg(F.min("first_id").alias("smallest"))
    of_sig = whole.join(smallest, "component").select("s", "smallest")
    slim = sets.select("doc_id", "text_md5", "n_shingles", "sig")
    return slim.join(of_sig, slim.sig == of_sig.s, "left").select(
        "doc_id", "text_md5", "n_shingles", F.coalesce("smallest", "doc_id").alias("component_id"))


def jaccard_join(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links) per document.
    ``options`` as for ``linked``."""
    return linked(docs, **options).drop("text_md5")


def one_of_each_group(docs: DataFrame, **options) -> DataFrame:
    """The documents, with all their columns, that have the smallest id of their
    component (and those without an id). A ``doc_id`` with two texts loses only a text
    that is near one of a smaller id."""
    gone = linked(docs, **options).where("component_id <> doc_id").select(
        F.col("doc_id").alias("id"), F.col("text_md5").alias("md5")).distinct()
    # all columns in one struct, where no name can clash
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col("doc_id").cast("long").alias("id"),
                       F.unhex(F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")))).alias("md5"))
    return rows.join(gone, ["id", "md5"], "left_anti").select("row.*")
