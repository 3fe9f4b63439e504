"""Document fingerprints: MinHash over word shingles, and near duplicates from bands of them."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from aerolens.llm.common import WORD, fold_ascii, id_key, prepared
from aerolens.llm.components import components, links_in_groups
from aerolens.llm.shingles import mixed, shingles
from aerolens.session import materialized

PERMUTATIONS = 128
WORDS = 5
#: Shingles that all permutations go over at once: half a megabyte of hashes.
BLOCK = 512
_RANDOM = np.random.default_rng(20240229)
FACTORS = _RANDOM.integers(1, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SHIFTS = _RANDOM.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64)
EMPTY = np.full(PERMUTATIONS, 0xFFFF, dtype=">u2")
#: Null ids come last in descending order.
LOWEST = -(2**63)


def signature(text: str | None) -> np.ndarray:
    """16 bits of the least value of each universal hash ``(a * x + b) mod 2**64`` over a text's shingles."""
    found = shingles(WORD.findall(fold_ascii(text or "")), WORDS)
    if not len(found):
        return EMPTY
    least = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for begin in range(0, len(found), BLOCK):
        hashed = found[begin : begin + BLOCK, None] * FACTORS
        hashed += SHIFTS
        np.minimum(least, hashed.min(axis=0), out=least)
    bits = (mixed(least) >> np.uint64(48)).astype(">u2")
    # What stands for an empty text is never the fingerprint of another.
    bits[0] &= 0xFFFE
    return bits


def likeness(left: np.ndarray, right: np.ndarray) -> float:
    """The share of equal entries; 0 if just one of the two texts is empty."""
    if (left[0] == 0xFFFF) != (right[0] == 0xFFFF):
        return 0.0
    return float(np.mean(left == right))


def edited(text: str, following: str) -> str:
    """A text whose last half is replaced by as many code points, or all, from the start of the next."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def in_order(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Deal documents out by descending id, each bucket sorted and followed by the first row of the next.

    Bounds are quantiles of the ids alone. Only the first row of every bucket, an id and a text hash, comes to the
    driver. Texts are shuffled once. Null ids come last; rows of equal ids are ordered by the hash of
    their text. Columns: ``bucket, guest, _id, id, text``.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(
        F.coalesce(F.col(id_column).cast("bigint"), F.lit(LOWEST)).alias("_key"), F.xxhash64(text).alias("_tie"),
        F.col(id_column).cast("bigint").alias("id"), text.alias("text"),
    )
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = [i / count for i in range(1, count)]
    bounds = rows.select("_key").agg(F.percentile_approx("_key", cuts, 20 * count)).first()[0] if cuts else []
    bounds = sorted(set(bounds or []))
    bucket = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b > F.col("_key"))) if bounds else F.lit(0)
    rows = rows.withColumn("bucket", bucket)
    firsts = rows.groupBy("bucket").agg(F.max(F.struct("_key", "_tie")).alias("first")).collect()
    order = sorted((row["bucket"], *row["first"]) for row in firsts)
    heads = [(key, tie, order[i - 1][0]) for i, (_, key, tie) in enumerate(order)]
    table = spark.createDataFrame(heads, "_key bigint, _tie bigint, _before int")
    # As many rows as buckets.
    dealt = rows.join(F.broadcast(table), ["_key", "_tie"], "left").withColumn(
        "_to", F.when(F.col("_before").isNull(), F.array("bucket")).otherwise(F.array("bucket", "_before"))
    )
    placed = dealt.select("*", F.posexplode("_to").alias("_place", "_bucket")).select(
        F.col("_bucket").alias("bucket"), (F.col("_place") > 0).alias("guest"), "_key", "_tie", "id", "text"
    )
    # A bucket for each partition; by hash some would get several.
    return placed.repartitionById(count, F.col("bucket")).sortWithinPartitions(
        "bucket", "guest", F.desc("_key"), F.desc("_tie")
    ).select("bucket", "guest", "id", "text")


def fingerprints(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Fingerprint of every text, of its edited text, and how like they and the next document are.

    The next document is the one of the next smaller id; after the last comes the first. The edited text has
    its last half (code points, rounded down) replaced from the start of the next text. Returns per row the
    id, ``n_chars``, ``edited_sha256``, ``fingerprint`` and ``edited_fingerprint`` (hexadecimal),
    ``near_edited`` and ``near_next`` (shares of equal entries, estimates of the Jaccard similarity).

    A null text is empty; a text without words has a fingerprint like no other. Rows of equal ids follow
    one another by the hash of their text; a null id is below all others. Of an only row the next is the row itself.
    A task holds two documents at a time.
    """
    prepared(docs.sparkSession)
    names = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def work(arrived: Iterator[pa.RecordBatch]):
        before = None  # bucket, id, text, signature
        for batch in arrived:
            out = []
            for bucket, guest, key, value in zip(*(batch.column(i) for i in range(4))):
                bucket, guest, text = bucket.as_py(), guest.as_py(), value.as_py()
                if guest and before is None:
                    continue
                own = signature(text)
                if before is not None and before[0] == bucket:
                    changed = edited(before[2], text)
                    changed_bits = signature(changed)
                    out.append((
                        before[1], len(before[2]),
                        hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
                        before[3].tobytes().hex(), changed_bits.tobytes().hex(),
                        likeness(before[3], changed_bits), likeness(before[3], own),
                    ))
                # After the first guest a bucket is done.
                before = None if guest else (bucket, key.as_py(), text, own)
            columns = list(zip(*out)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    return in_order(docs, id_column, text_column).mapInArrow(
        work, "id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    ).withColumnRenamed("id", id_column)


#: Entries of a signature in one band: sets of similarity 0.8 share one of 32 such bands with a chance of 0.99999.
BAND = 4


def _all(group: pa.Table):
    return lambda i, near: near


def near_duplicates(
    docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", percent: int = 80
) -> DataFrame:
    """``id, component_id`` of every document: the smallest id that links of similar documents lead to.

    Documents that share a band of their signatures are candidates, found by a join on the band; a link is verified on
    the exact sets of five-word shingles. Equal sets are put together first, and ``links_in_groups`` keeps groups of near
    copies from becoming all their pairs. A text without words is linked with nothing, a null id is one id.
    """
    prepared(docs.sparkSession)
    texts = docs.select(id_key(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    names = ["id", "digest", "bands", "tokens"]

    def work(arrived):
        for batch in arrived:
            out = []
            for key, text in zip(*(c.to_pylist() for c in batch.columns)):
                tokens = shingles(WORD.findall(fold_ascii(text)), WORDS)
                bits = signature(text).tobytes()
                bands = [bytes([i]) + bits[2 * BAND * i : 2 * BAND * (i + 1)] for i in range(PERMUTATIONS // BAND)]
                out.append((key, hashlib.sha256(tokens.tobytes()).digest(), bands if len(tokens) else [], tokens.view(np.int64)))
            kinds = [pa.int64(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*out)) or [[]] * 4, kinds)], names)

    signed = materialized(
        texts.mapInArrow(work, "id bigint, digest binary, bands array<binary>, tokens array<bigint>"), "signatures"
    )
    first = signed.where("size(bands) > 0").groupBy("digest").agg(F.min("id").alias("first"))
    leaders = signed.join(first, "digest").where("id = first").dropDuplicates(["id", "digest"])
    hashed = F.transform("bands", lambda b: F.xxhash64(b))
    members = leaders.select("id", F.size("tokens").cast("bigint").alias("n"), F.explode(hashed).alias("band"))
    members = materialized(members.distinct(), "members")
    sets = materialized(leaders.select("id", "tokens"), "sets")
    links = links_in_groups(
        members, ["band"], [], lambda x, y: F.lit(True), _all, _all,
        lambda ids: sets.join(ids, "id", "left_semi"), percent,
    )
    copies = signed.join(first, "digest").where("id <> first").select(F.col("id").alias("a"), F.col("first").alias("b"))
    found = components(links.union(copies).distinct())
    ids = signed.select("id").distinct()
    return ids.join(found, ids["id"] == found["node"], "left").select(
        F.when(F.col("id") != 2**63 - 1, F.col("id")).alias(id_column), F.coalesce("component", "id").alias("component_id")
    )
