"""Near copies by covering SimHash (operator 6), with the exact Jaccard similarity of their word shingles as a check.

Texts with the same set of shingles are one node, which has a SimHash fingerprint. Nodes whose fingerprints differ in RADIUS bits at most
meet under the covering masks of operator 6. At a similarity of 0.8 some 10 bits differ, so nodes also meet where BAND_ROWS
minima of independently scrambled shingle hashes agree in one of BANDS bands. At a similarity s that happens with a chance of
1 - (1 - s^BAND_ROWS)^BANDS: 0.99994 at 0.8, more above. Every pair that meets is linked by its exact similarity, or is
connected already by such links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm.components import components
from bazaarlake.llm.simhash import GROUP_ROWS, RADIUS, majority
from bazaarlake.llm.simhash import links as covering_links
from bazaarlake.llm.storage import WIDE_ROWS, drop_table, write_table
from bazaarlake.llm.text import LOWER, WORDS, pieces

SHINGLE_WORDS = 5
# Least similarity of near copies, as numerator and denominator.
LEAST = (4, 5)
BANDS, BAND_ROWS = 32, 6
SEED = 42
# Rows of up to 40 bytes that are sent to all executors; longer tables are joined by a shuffle.
BROADCAST_ROWS = 500_000
# Shingles that are scrambled at once.
PART = 4096

NODES = "doc_id long, text_hash long, node binary, size long, fp long, keys array<long>"


def shingles(text: str | None, k: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct hashes of the shingles of k words; of fewer words there is one shingle, of no words none."""
    found, words, digest = [], [], xxhash.xxh64_intdigest
    for piece in pieces((text or "").encode("utf-8", "surrogatepass").translate(LOWER)):
        words = words[-(k - 1) :] if k > 1 and found else words
        words = words + WORDS.findall(piece)
        if len(words) >= k:
            joined, ends = b" ".join(words), np.cumsum([len(w) + 1 for w in words]) - 1
            starts = np.concatenate([[0], ends[:-1] + 1])
            spans = zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)
            found.append(np.array([digest(joined[a:b], SEED) for a, b in spans], np.uint64))
    if not found and words:
        found.append(np.array([digest(b" ".join(words), SEED)], np.uint64))
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint64)


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether the similarity of two sorted sets is LEAST or more."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both * LEAST[1] >= (len(a) + len(b) - both) * LEAST[0]


def _scramblers() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    drawn = rng.integers(0, 1 << 64, (2, BANDS * BAND_ROWS, 1), np.uint64, endpoint=False)
    return drawn[0], drawn[1] | np.uint64(1)


def band_keys(hashes: np.ndarray, scramblers: tuple[np.ndarray, np.ndarray]) -> list[int]:
    """One number of 64 bits for each band; none for an empty set."""
    if not len(hashes):
        return []
    flip, factor = scramblers
    least = np.full(len(flip), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), PART):
        least = np.minimum(least, ((hashes[at : at + PART] ^ flip) * factor).min(axis=1))
    bands = least.reshape(BANDS, BAND_ROWS)
    return np.array([xxhash.xxh64_intdigest(band.tobytes(), number) for number, band in enumerate(bands)], np.uint64).view(np.int64).tolist()


def _nodes(docs: DataFrame, shingle_words: int) -> DataFrame:
    """NODES: the node of every row, which names its set of shingles by 128 bits."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scramblers = _scramblers()
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                hashes = shingles(text.as_py(), shingle_words)
                rows.append((xxhash.xxh3_128_digest(hashes.tobytes()), len(hashes), majority(hashes), band_keys(hashes, scramblers)))
            node, size, fp, keys = zip(*rows, strict=True) if rows else ([], [], [], [])
            signed = pa.array(np.array(fp, np.uint64).view(np.int64))
            arrays = [pa.array(node, pa.binary()), pa.array(size, pa.int64()), signed, pa.array(keys, pa.list_(pa.int64()))]
            names = [part.split()[0] for part in NODES.split(", ")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), *arrays], names=names)

    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(scan, NODES)


def _sets(docs: DataFrame, wanted: DataFrame, shingle_words: int) -> DataFrame:
    """node and its set, for one row (doc_id, text_hash) of each node."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingles(t.as_py(), shingle_words).view(np.int64) for t in batch.column("text")]
            hashes = pa.array(found, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("node"), hashes], names=["node", "hashes"])

    texts = docs.select(F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_hash"), "text")
    same = F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_hash") == F.col("text_hash"))
    found = texts.join(small(wanted), same).select("node", "text")
    return found.mapInArrow(scan, "node binary, hashes array<long>")


def small(rows: DataFrame) -> DataFrame:
    """A written table with a hint to send it to all executors, if it has BROADCAST_ROWS narrow rows at most."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that are similar."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = zip(batch.column("_a"), batch.column("_b"), strict=True)
            good = [similar(*(v.values.to_numpy().view(np.uint64) for v in pair)) for pair in columns]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    left = sets.select(F.col("node").alias("a"), F.col("hashes").alias("_a"))
    right = sets.select(F.col("node").alias("b"), F.col("hashes").alias("_b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "_a", "_b").mapInArrow(scan, "a binary, b binary")


def _near_size(a: str, b: str) -> Column:
    """Whether sets of these sizes can be similar."""
    return F.least(a, b) * LEAST[1] >= F.greatest(a, b) * LEAST[0]


def _covered_pairs(nodes: DataFrame) -> DataFrame:
    """Written: pairs (a, b) of nodes of near sizes that meet under the covering masks of operator 6.

    Of the nodes of one fingerprint the first stands for all: the others are paired with it, and it with those of linked fingerprints.
    """
    nodes = nodes.filter("size > 0").select("fp", "node", "size")
    first = write_table(nodes.groupBy("fp").agg(F.min(F.struct("node", "size")).alias("f")).select("fp", "f.*"), "near-fingerprints")
    linked = covering_links(first.select("fp"), RADIUS, RADIUS, GROUP_ROWS)
    x, y = (first.select(F.col("fp").alias(c), F.col("node").alias(f"{c}_node"), F.col("size").alias(f"{c}_size")) for c in "ab")
    columns = ["a_node", "a_size", "b_node", "b_size"]
    equal = nodes.select(F.col("fp").alias("a"), F.col("node").alias("b_node"), F.col("size").alias("b_size")).join(x, "a")
    met = linked.join(x, "a").join(y, "b").select(columns).unionByName(equal.filter("a_node <> b_node").select(columns))
    met = met.filter(_near_size("a_size", "b_size"))
    met = met.select(F.least("a_node", "b_node").alias("a"), F.greatest("a_node", "b_node").alias("b")).distinct()
    met = write_table(met, "near-covered")
    drop_table(linked)
    drop_table(first)
    return met


def _star_pairs(rows: DataFrame) -> DataFrame:
    """Every row (key, node, size, n) with the most central node of its key: the one whose keys have most rows in all."""
    weights = rows.groupBy("node").agg(F.sum("n").alias("weight"))
    star = rows.join(weights, "node").groupBy("key").agg(F.max(F.struct("weight", "node", "size")).alias("star"))
    met = rows.join(star, "key").filter((F.col("node") != F.col("star.node")) & _near_size("size", "star.size"))
    return met.select(F.least("node", "star.node").alias("a"), F.greatest("node", "star.node").alias("b")).distinct()


def _rare_prefixes(left: DataFrame, sets: DataFrame) -> DataFrame:
    """Written: shingle, node, size, root and place of the rarest shingles of each node: those of which similar nodes must share one.

    The places are counted from the rarest shingle of a node to the most frequent one, so that the shingles that only one node
    has come first. They are counted but need not be listed. A node has at most as many rows as a fifth of its shingles.
    """
    shingle = left.join(sets, "node").select("node", "root", F.size("hashes").alias("size"), F.explode("hashes").alias("shingle"))
    shingle = write_table(shingle, "near-shingles")
    frequency = write_table(shingle.groupBy("shingle").agg(F.count("*").alias("n")).filter("n > 1"), "near-frequencies")
    lists = shingle.join(frequency, "shingle").groupBy("node", "root", "size")
    lists = lists.agg(F.sort_array(F.collect_list(F.struct("n", "shingle"))).alias("found"))
    alone, far = F.col("size") - F.size("found"), F.expr(f"size - (size * {LEAST[0]} + {LEAST[1] - 1}) DIV {LEAST[1]} + 1")
    listed = lists.select("node", "root", "size", alone.alias("alone"), F.greatest(far - alone, F.lit(0)).cast("int").alias("take"), "found")
    listed = listed.select("node", "root", "size", "alone", F.posexplode(F.slice("found", F.lit(1), F.col("take"))).alias("at", "rare"))
    listed = listed.select("rare.shingle", "node", "root", "size", (F.col("alone") + F.col("at")).alias("place"))
    listed = write_table(listed, "near-prefixes")
    drop_table(shingle)
    drop_table(frequency)
    return listed


def _rare_pairs(prefixes: DataFrame) -> DataFrame:
    """Pairs of different roots that share a rare shingle so early that as many as it takes can still be equal.

    Of similar sets x and y, x not larger, the first common shingle lies early in both: what follows it, and itself, must reach
    the number of shingles that they have in common at least. No similar pair is lost.
    """
    both = LEAST[0] + LEAST[1]
    early = F.expr(f"size - (size * {2 * LEAST[0]} + {both - 1}) DIV {both} + 1")
    x = prefixes.filter(F.col("place") < early)
    y = prefixes.select("shingle", *(F.col(c).alias(f"_{c}") for c in ("node", "root", "size", "place")))
    first = (F.col("size") < F.col("_size")) | ((F.col("size") == F.col("_size")) & (F.col("node") < F.col("_node")))
    common = F.least(F.col("size") - F.col("place"), F.col("_size") - F.col("_place")) * both
    enough = common >= (F.col("size") + F.col("_size")) * LEAST[0]
    same = x["shingle"] == y["shingle"]
    met = x.join(y, same & first & enough & (F.col("root") != F.col("_root")))
    return met.select(F.least("node", "_node").alias("a"), F.greatest("node", "_node").alias("b")).distinct()


def _rooted(docs: DataFrame, shingle_words: int) -> DataFrame:
    """doc_id, text_hash, node and root of every row, written; linked nodes have one root."""
    marked = write_table(_nodes(docs, shingle_words), "near-marked", batch_rows=WIDE_ROWS)
    one = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash", "size", "fp", "keys")).alias("k")
    nodes = marked.groupBy("node").agg(one)
    nodes = write_table(nodes.select("node", "k.doc_id", "k.text_hash", "k.size", "k.fp", "k.keys"), "near-nodes")
    covered = _covered_pairs(nodes)
    keyed = nodes.select("node", "size", F.explode("keys").alias("key"))
    several = keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    rows = write_table(keyed.join(several, "key"), "near-rows")
    meeting = rows.select("node").union(covered.select("a")).union(covered.select("b")).distinct()
    wanted = nodes.join(meeting, "node", "left_semi").select("node", "doc_id", "text_hash")
    wanted = write_table(wanted, "near-wanted")
    sets = write_table(_sets(docs, wanted, shingle_words).dropDuplicates(["node"]), "near-sets", batch_rows=WIDE_ROWS)
    pairs = write_table(covered.union(_star_pairs(rows)).distinct(), "near-pairs")
    links = write_table(_verified(pairs, sets), "near-links", batch_rows=WIDE_ROWS)
    roots = components(links)
    known = roots.select("node", F.col("root").alias("known"))
    named = rows.join(known, "node", "left").select("key", "node", F.coalesce("known", "node").alias("root"))
    named = write_table(named, "near-named")
    apart = named.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high")
    left = write_table(named.join(apart.select("key"), "key").select("node", "root").distinct(), "near-left")
    drop_table(named)
    prefixes = _rare_prefixes(left, sets)
    more = write_table(_verified(write_table(_rare_pairs(prefixes), "near-pairs"), sets), "near-links", batch_rows=WIDE_ROWS)
    if not more.isEmpty():
        roots = components(links.unionByName(more))
    named = nodes.select("node").join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"))
    found = write_table(marked.drop("keys", "size", "fp").join(named, "node"), "near-components")
    for table in (marked, nodes, covered, rows, wanted, sets, pairs, links, more, prefixes, left):
        drop_table(table)
    return found


def near_copies(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, text_hash, node and component_id of every row of docs (doc_id, text); node stands for the set of shingles.

    component_id is the smallest doc_id that links reach. Null doc_ids are never the smallest (a component of only such
    rows has a null id; ``root`` tells these apart); texts without words are one node. Repeated rows stay.

    Nodes that meet under the covering masks of operator 6 are compared. All nodes of a band key are compared with its most central one, which connects dense groups by as many comparisons as they
    have members. What is still apart in some key is compared by its rare shingles: similar sets share one
    of a fifth of them, so texts that have a part in common but differ otherwise are not compared, however many they are.
    """
    found = _rooted(docs, shingle_words)
    least = found.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return found.join(write_table(least, "near-least"), "root")


def keep_one(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """One row of each component of near copies, with all its columns: the one with the smallest doc_id.

    Rows with the same doc_id are told apart by a hash of their text; rows without a doc_id come last. Of rows that repeat
    doc_id and text one stays. Only the rows that go, and repeated ones, are looked up.
    """
    found = _rooted(docs, shingle_words)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash", "node")
    first = write_table(found.groupBy("root").agg(F.min(order).alias("k")).select("root", "k.*"), "near-first")
    name = ["doc_id", "text_hash"]
    first = first.select("root", *(F.col(c).alias(f"_{c}") for c in name))
    rows = found.groupBy("root", *name).agg(F.count("*").alias("n")).join(first, "root")
    stays = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("text_hash") == F.col("_text_hash"))
    odd = rows.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), stays.alias("_stays"), "n").filter("NOT _stays OR n > 1")
    odd = write_table(odd.groupBy("_id", "_hash").agg(F.max("_stays").alias("_stays")), "near-odd")
    texts = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("row_id"), F.xxhash64("text").alias("row_hash"))
    same = F.col("row_id").eqNullSafe(F.col("_id")) & (F.col("row_hash") == F.col("_hash"))
    rest = texts.join(small(odd), same, "left_anti")
    repeated = odd.filter("_stays")
    if not repeated.isEmpty():
        rest = rest.unionByName(texts.join(small(repeated), same, "left_semi").dropDuplicates(["row_id", "row_hash"]))
    return rest.select("row.*")
