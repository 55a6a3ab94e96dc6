"""Near duplicates by bottom-k sketches from one hash function.

1. Every document becomes its set of word shingles and the few smallest hashes of the
   set. Documents with equal sets form a class; one of them stands for it. Similar sets
   share most of those few, so a document of which too few occur elsewhere has no partner.
2. The others get their sketch, the `k` smallest hashes. Two similar sets share so much of
   their sketches that they share one of the rarest values; so each sketch enters the
   inverted lists only with as many of its rarest values as that needs. Text that many
   documents share has common values, which fill no list unless a document holds little
   else. Where a sketch is the whole set, the place of a value in it bounds the overlap.
3. A list proposes pairs of its members with two leaders, which is linear in the list.
   The bottom values of the union of two sketches estimate the similarity; pairs that may
   reach the threshold are confirmed on the full sets. Confirmed links give components.
4. What lists join, similar or not, is a neighbourhood; no similar pair crosses one. The
   members of a neighbourhood that are still in different components are compared block by
   block: products of the blocks' sketches bound the overlaps, and pairs that may be
   similar are confirmed on the full sets unless links already join them. Blocks have a
   fixed size, so that no list is capped and no task holds a neighbourhood.

Every step is a written table or a join that splits hot keys.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterwise.llm import bloom
from meterwise.llm.common import as_bytes, chained, hashed_words, word_hashes, worker_alone, written
from meterwise.llm.components import components

cloudpickle.register_pickle_by_value(sys.modules[__name__])

K = 256
# Values that tell whether a document can have a partner, and that estimate a pair.
HEAD = 16
PAIR = 64
# Standard deviations that an overlap of sketches may fall short of its mean.
SLACK = 5.0
# Texts that are compared with one leader in one task.
CHUNK = 200
# Texts of a block; two blocks are compared in one task.
BLOCK = 400
# Shared values that a product of sketches takes at a time.
COLUMNS = 1024

HEADS = "doc_id BIGINT, n BIGINT, digest BINARY, head ARRAY<BIGINT>"
SKETCHES = "node BIGINT, n BIGINT, digest BINARY, sketch ARRAY<BIGINT>, z BINARY"


def shingle_set(text: bytes, size: int, known) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a text, A-Z lower-cased: runs of `size`
    words, or all words where there are fewer."""
    words = hashed_words(text.lower().split(), known)
    steps = tuple(range(min(size, len(words))))
    return np.unique(chained(words, steps).view(np.int64)) if steps else np.empty(0, np.int64)


def digest(shingles: np.ndarray) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(shingles.tobytes())


def heads(source: DataFrame, shingle: int) -> DataFrame:
    """HEADS of all documents."""

    def head(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_alone("shingles")
        known = word_hashes()
        for batch in batches:
            sets = [shingle_set(t, shingle, known) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([digest(s) for s in sets], pa.binary()),
                    pa.array([s[:HEAD] for s in sets], pa.list_(pa.int64())),
                ],
                ["doc_id", "n", "digest", "head"],
            )

    return source.mapInArrow(head, HEADS)


def sketches(source: DataFrame, shingle: int, k: int, among) -> DataFrame:
    """SKETCHES, with the compressed text, of the documents whose id may be in the filter
    `among`."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        known, squeeze = word_hashes(), zstandard.ZstdCompressor(level=3).compress
        for batch in bloom.sieve(among, "doc_id", True)(batches):
            texts = batch.column("text").to_pylist()
            sets = [shingle_set(t, shingle, known) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([digest(s) for s in sets], pa.binary()),
                    pa.array([s[:k] for s in sets], pa.list_(pa.int64())),
                    pa.array([squeeze(t) for t in texts], pa.binary()),
                ],
                ["node", "n", "digest", "sketch", "z"],
            )

    return source.mapInArrow(sketch, SKETCHES)


def _least_common(n: Column, k: int, threshold: float) -> Column:
    """How many of a set's `k` smallest values are among those of a similar set at least;
    exact where both must be whole sets. A set of little less than `k` values may meet a
    larger one, which shows only its smallest values."""
    exact, sure = F.ceil(n * threshold), _sure(F.lit(k), threshold)
    return F.when(n <= threshold * k, exact).when(n <= k, F.least(exact, sure)).otherwise(sure)


def with_partners(classes: DataFrame, threshold: float) -> DataFrame:
    """(node, at, digest) of the classes that may be similar to another."""
    values = classes.select("node", F.explode("head").alias("v"))
    counts = values.groupBy("v").agg(F.count(F.lit(1)).alias("df")).where("df > 1").select("v")
    shared = values.join(counts, "v").groupBy("node").agg(F.count(F.lit(1)).alias("shared"))
    enough = F.col("shared") >= _least_common(F.col("n"), HEAD, threshold)
    found = classes.select("node", "at", "n", "digest").join(shared, "node").where(enough)
    return found.select("node", "at", "digest")


def _sure(n: Column, share: float) -> Column:
    """How many of `n` drawn values are common at least, if `share` of all are."""
    return F.floor(n * share - SLACK * math.sqrt(share * (1 - share)) * F.sqrt(n))


def may_be_similar(x: Column, y: Column, k: int, threshold: float) -> Column:
    """Whether the bottom k of the union of two sketches lets the sets be similar. Where
    the union has no more than k values it is the whole union, and the test exact."""
    union = F.array_sort(F.array_union(x, y))
    bottom = F.slice(union, 1, k)
    common = F.size(F.array_intersect(F.array_intersect(bottom, x), y))
    n = F.size(bottom)
    least = F.when(F.size(union) < k, F.ceil(n * threshold)).otherwise(_sure(n, threshold))
    return common >= least


def inverted_lists(reps: DataFrame, k: int, threshold: float) -> DataFrame:
    """(v, node, n, rest): the rarest values of every sketch, as many as similar sets must
    share one of, without those that no other document has. `rest` counts the values from
    this one on, in the order of rarity."""
    values = reps.select("node", F.explode("sketch").alias("v"))
    counts = values.groupBy("v").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    held = F.array_sort(F.collect_list(F.struct("df", "v")))
    known = values.join(counts, "v").groupBy("node").agg(held.alias("held"))
    known = known.join(reps.select("node", "n"), "node")
    whole = F.least("n", F.lit(k))
    # Values of one document only come first.
    alone = whole - F.size("held")
    take = (whole - _least_common(F.col("n"), k, threshold) + 1 - alone).cast("int")
    listed = known.where(take > 0).select(
        "node", "n", whole.alias("whole"), alone.alias("alone"),
        F.posexplode(F.slice("held", 1, take)).alias("place", "h"),
    )
    rest = F.col("whole") - F.col("alone") - F.col("place")
    return listed.select(F.col("h.v").alias("v"), "node", "n", rest.alias("rest"))


def may_overlap(n_a: str, n_b: str, rest_a: str, rest_b: str, k: int, threshold: float) -> Column:
    """Whether sizes and places allow the similarity of two members of a list, if they
    share no rarer value; another list has those that do."""
    enough = threshold / (1 + threshold) * (F.col(n_a) + F.col(n_b)) - 1e-6
    # Where sketches are samples the places are, too: they have been counted with slack.
    sample = F.greatest(n_a, n_b) > k
    sizes = F.least(n_a, n_b) >= F.greatest(n_a, n_b) * threshold - 1e-6
    return sizes & (sample | (F.least(rest_a, rest_b) >= enough))


def leader_pairs(lists: DataFrame, k: int, threshold: float) -> DataFrame:
    """Distinct (a, b): the members of every list with two of them: the one for which the
    value is rarest, and any one."""
    mixed = F.xxhash64("node")
    member = F.struct("node", "n", "rest")
    leaders = lists.groupBy("v").agg(
        F.min_by(member, F.struct(-F.col("rest") / F.col("n"), mixed)).alias("l1"),
        F.min_by(member, mixed).alias("l2"), F.count(F.lit(1)).alias("size"),
    ).where("size > 1")
    met = lists.join(leaders, "v").select(
        "node", "n", "rest", F.explode(F.array_distinct(F.array("l1", "l2"))).alias("leader")
    ).select("node", "n", "rest", *[F.col(f"leader.{c}").alias(f"l_{c}") for c in ("node", "n", "rest")])
    fit = met.where("node <> l_node").where(may_overlap("n", "l_n", "rest", "l_rest", k, threshold))
    return fit.select(F.col("l_node").alias("a"), F.col("node").alias("b")).distinct()


def estimated(pairs: DataFrame, reps: DataFrame, k: int, threshold: float) -> DataFrame:
    """The pairs that sketches let be similar."""
    few = min(k, PAIR)
    side = lambda c: reps.select(
        F.col("node").alias(c), F.slice("sketch", 1, few).alias(f"sketch_{c}")
    )
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return both.where(
        may_be_similar(F.col("sketch_a"), F.col("sketch_b"), few, threshold)
    ).select("a", "b")


def confirmed(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs whose full sets are similar: those of one `a` in chunks of bounded size,
    each with a copy of its text."""
    degrees = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / CHUNK).alias("chunks"))
    dealt = pairs.join(degrees, "a").select(
        "a", "b", F.pmod(F.xxhash64("b"), F.col("chunks")).alias("chunk")
    )
    need = dealt.select("a", "chunk", F.col("b").alias("node")).unionByName(
        dealt.select("a", "chunk", F.col("a").alias("node")).distinct()
    )

    def confirm(group: pa.Table) -> pa.Table:
        import zstandard

        known, inflate = word_hashes(), zstandard.ZstdDecompressor().decompress
        sets = {
            node: shingle_set(inflate(z), shingle, known)
            for node, z in zip(group.column("node").to_pylist(), group.column("z").to_pylist())
        }
        a = group.column("a")[0].as_py()
        found = []
        for b, s in sets.items():
            common = len(np.intersect1d(sets[a], s, assume_unique=True))
            if b != a and 100 * common >= percent * (len(s) + len(sets[a]) - common):
                found.append(b)
        return pa.table({"a": pa.array([a] * len(found), pa.int64()), "b": pa.array(found, pa.int64())})

    return need.join(texts, "node").groupBy("a", "chunk").applyInArrow(confirm, "a BIGINT, b BIGINT")


def neighbourhoods(lists: DataFrame) -> DataFrame:
    """(node, component) by the lists: every member hangs on its list's smallest one."""
    least = lists.groupBy("v").agg(F.min("node").alias("least"))
    edges = lists.select("v", "node").join(least, "v").where("node <> least")
    return components(edges.select(F.col("least").alias("a"), F.col("node").alias("b")).distinct())


def residual_links(
    lists: DataFrame, reps: DataFrame, found: DataFrame, k: int, shingle: int, percent: int
) -> DataFrame:
    """(a, b): similar pairs of one neighbourhood that join the components `found`: enough
    of them to join all that similar pairs do."""
    threshold = percent / 100
    members = lists.select("node").distinct()
    name = lambda df, c: df.withColumnRenamed("component", c)
    named = (
        members.join(name(neighbourhoods(lists), "hood"), "node", "left")
        .join(name(found, "c"), "node", "left")
        .select("node", F.coalesce("hood", "node").alias("hood"), F.coalesce("c", "node").alias("c"))
    )
    named = written(named, "named")
    sizes = named.groupBy("hood").agg(
        F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"),
        F.min("c").alias("low"), F.max("c").alias("high"),
    ).where("low <> high").select("hood", "blocks")
    dealt = named.join(sizes, "hood").withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    )
    # Every pair of blocks, a block with itself included.
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = dealt.select("node", "hood", "c", "block", others).select(
        "node", "hood", "c", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        "block",
    )
    placed = dealt.join(reps.select("node", "n", "sketch", "z"), "node")

    def compare(group: pa.Table) -> pa.Table:
        links = block_links(
            *(group.column(c).to_pylist() for c in ("node", "c", "block", "n", "sketch", "z")),
            k, shingle, threshold, percent,
        )
        a, b = zip(*links) if links else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return placed.groupBy("hood", "i", "j").applyInArrow(compare, "a BIGINT, b BIGINT")


def block_links(nodes, named, blocks, n, sketches, z, k, shingle, threshold, percent) -> list[tuple[int, int]]:
    """Similar pairs that join different components, of two blocks or within one."""
    import zstandard

    inflate = zstandard.ZstdDecompressor().decompress
    m = len(nodes)
    sizes = np.array([len(s) for s in sketches], np.int64)
    rows = np.repeat(np.arange(m), sizes)
    values, columns = np.unique(np.concatenate([np.asarray(s, np.int64) for s in sketches]), return_inverse=True)
    often = np.bincount(columns) > 1
    keep = often[columns]
    rows, columns = rows[keep], (np.cumsum(often) - 1)[columns[keep]]
    common = np.zeros((m, m), np.float32)
    for low in range(0, int(often.sum()), COLUMNS):
        here = (columns >= low) & (columns < low + COLUMNS)
        part = np.zeros((m, COLUMNS), np.float32)
        part[rows[here], columns[here] - low] = 1
        common += part @ part.T
    # Below the smaller of two sketches' largest values both sketches are complete.
    n = np.asarray(n)
    last = np.array([s[-1] if len(s) >= k else np.iinfo(np.int64).max for s in sketches])
    upto = np.empty((m, m), np.int64)  # values of the column's sketch up to the row's last
    for y, s in enumerate(sketches):
        upto[:, y] = np.searchsorted(np.asarray(s, np.int64), last, "right")
    union = np.where(last[:, None] <= last[None, :], sizes[:, None] + upto, sizes[None, :] + upto.T) - common
    whole = (last == np.iinfo(np.int64).max)
    exact = whole[:, None] & whole[None, :]
    slack = np.where(exact, 0.0, SLACK * np.sqrt(threshold * (1 - threshold) * union))
    near = common + 1e-3 >= threshold * union - slack
    near &= np.minimum(n[:, None], n[None, :]) >= threshold * np.maximum(n[:, None], n[None, :]) - 1e-6
    block, named = np.asarray(blocks), np.asarray(named)
    if (block != block[0]).any():
        near &= block[:, None] != block[None, :]
    near &= named[:, None] != named[None, :]
    xs, ys = np.nonzero(np.triu(near, 1))
    order = np.argsort(-(common[xs, ys] / union[xs, ys]), kind="stable")
    known, sets, links = word_hashes(), {}, []
    root = {c: c for c in named.tolist()}

    def find(c: int) -> int:
        while root[c] != c:
            root[c] = root[root[c]]
            c = root[c]
        return c

    def whole_set(x: int) -> np.ndarray:
        if x not in sets:
            sets[x] = shingle_set(inflate(z[x]), shingle, known)
        return sets[x]

    for x, y in zip(xs[order].tolist(), ys[order].tolist()):
        a, b = find(int(named[x])), find(int(named[y]))
        if a == b:
            continue
        p, q = whole_set(x), whole_set(y)
        both = len(np.intersect1d(p, q, assume_unique=True))
        if 100 * both >= percent * (len(p) + len(q) - both):
            root[a] = b
            links.append((nodes[x], nodes[y]))
    return links


def same_id_links(searched: DataFrame, classes: DataFrame) -> DataFrame | None:
    """(a, b): the classes of different texts with one id; None where no id repeats so."""
    spread = searched.groupBy("doc_id").agg(F.min("digest").alias("first"), F.max("digest").alias("last"))
    twice = written(spread.where("first <> last").select("doc_id", "first"), "twice")
    if twice.isEmpty():
        return None
    pairs = searched.join(twice, "doc_id").where("digest <> first").select("digest", "first").distinct()
    name = lambda key, node: classes.select(F.col("digest").alias(key), F.col("node").alias(node))
    return pairs.join(name("digest", "a"), "digest").join(name("first", "b"), "first").select("a", "b")


def near_duplicates(
    docs: DataFrame, shingle: int = 5, percent: int = 80, k: int = K
) -> DataFrame:
    """(doc_id, n_shingles, component_id, links) of every row of `docs` (doc_id, text).

    Documents are linked if their sets of word shingles overlap by at least `percent` of
    their union; `component_id` is the smallest id that links reach, `links` counts the
    confirmed links of the document's class that the search needed.

    A-Z are lower-cased before words are taken, other letters stay as they are. Null and
    empty texts and texts without words have the empty set and no links. Rows
    with a null id get a null component and no links. Rows that repeat an id are one
    document: what any of their texts is similar to is linked. Other columns are ignored.
    An empty table gives an empty one.
    """
    threshold = percent / 100
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), as_bytes().alias("text"))
    all_heads = written(heads(source, shingle), "heads")
    searched = all_heads.where("doc_id IS NOT NULL AND n > 0")
    classes = searched.groupBy("digest").agg(
        F.min("doc_id").alias("at"), F.first("n").alias("n"), F.first("head").alias("head")
    )
    # A class goes by its smallest id, or by its digest where that id stands for another.
    one = classes.groupBy("at").agg(F.min("digest").alias("keeper"))
    node = F.when(F.col("digest") == F.col("keeper"), F.col("at")).otherwise(F.xxhash64("digest"))
    classes = written(classes.join(one, "at").withColumn("node", node).drop("keeper"), "classes")
    wanted = written(with_partners(classes, threshold), "wanted")
    found = sketches(source, shingle, k, bloom.bloom(wanted.select("at")))
    found = found.withColumnRenamed("node", "at").join(wanted, ["at", "digest"])
    # Rows may be repeated whole.
    reps = found.dropDuplicates(["node"]).select("node", "n", "sketch", "z")
    reps = written(reps, "sketches")
    texts = reps.select("node", "z")
    lists = written(inverted_lists(reps, k, threshold), "lists")
    tried = written(estimated(leader_pairs(lists, k, threshold), reps, k, threshold), "tried")
    links = written(confirmed(tried, texts, shingle, percent), "links")
    rest = residual_links(lists, reps, written(components(links), "found"), k, shingle, percent)
    links = links.unionByName(written(rest, "rest"))
    same = same_id_links(searched, classes)
    found = components(links if same is None else links.unionByName(same))
    degrees = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(
        F.count(F.lit(1)).alias("links")
    )
    named = classes.select("node", "at", "digest").join(found, "node", "left").select(
        "node", "at", "digest", F.coalesce("component", "node").alias("name")
    )
    if same is None:
        named = named.withColumnRenamed("name", "component")
    else:
        # Names other than ids: the smallest id of each component.
        named = written(named, "labels")
        least = named.groupBy("name").agg(F.min("at").alias("component"))
        named = named.join(least, "name")
    named = named.join(degrees, "node", "left").select(
        "digest", "component", F.coalesce("links", F.lit(0)).alias("links")
    )
    rows = all_heads.select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("digest")).alias("digest"),
    )
    return rows.join(named, "digest", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce("links", F.lit(0)).alias("links"),
    )
