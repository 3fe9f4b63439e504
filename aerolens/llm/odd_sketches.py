"""Near-duplicate documents by MinHash bands, odd sketches and an exact check.

Every distinct set of word shingles gets MinHash samples. Sets that share a band of samples are candidates. All samples
of a set are also folded into a bitmap of parities, its odd sketch: each sample flips one bit. Samples that two sets
have in common cancel out in the exclusive or of their sketches, so the bits left there tell how many samples differ,
most precisely where few do. Candidates with more such bits than similar sets have are let go; the others are checked on
their full sets.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from aerolens.llm.common import NULL_ID, WORD, fold_ascii, id_key, prepared
from aerolens.llm.components import block_links, components, ordered_pair, stored_sets, verified_by_sets, with_partner
from aerolens.llm.shingles import mixed, shingles
from aerolens.session import materialized

#: Sets of similarity 0.8 share one of 40 bands of 5 samples with a chance of 1 - 1.2e-7.
BANDS, BAND = 40, 5
SAMPLES = BANDS * BAND
#: Bits of an odd sketch, kept as 64-bit words.
BITS = 512
SKETCH = [f"s{i}" for i in range(BITS // 64)]
#: Standard deviations by which a similar pair's sketches may differ more than expected.
DEVIATIONS = 6.0
#: Stars of one band have one of so many different centres, so that several join a group of near copies.
CENTRES = 4
#: Shingles that all permutations go over at once.
AT_ONCE = 1024
_RANDOM = np.random.default_rng(20240711)
FACTORS = (_RANDOM.integers(0, 1 << 31, SAMPLES, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
SHIFTS = _RANDOM.integers(0, 1 << 32, SAMPLES, dtype=np.uint64).astype(np.uint32)[:, None]
_PLACES = np.arange(SAMPLES, dtype=np.uint64)


def samples(tokens: np.ndarray) -> np.ndarray:
    """The least value of each universal hash ``(a * x + b) mod 2**32`` over a set that is not empty."""
    least = np.full(SAMPLES, 0xFFFFFFFF, dtype=np.uint32)
    low = (tokens >> np.uint64(32)).astype(np.uint32)
    for begin in range(0, len(low), AT_ONCE):
        hashed = low[None, begin : begin + AT_ONCE] * FACTORS
        hashed += SHIFTS
        np.minimum(least, hashed.min(axis=1), out=least)
    return least


def odd_sketch(found: np.ndarray) -> np.ndarray:
    """Parity bitmap of samples: sample ``i`` flips the bit that a hash of ``i`` and its value names."""
    places = mixed((_PLACES << np.uint64(32)) | found.astype(np.uint64)) % np.uint64(BITS)
    odd = (np.bincount(places.astype(np.int64), minlength=BITS) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.uint64)


def band_keys(found: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each band's number and samples."""
    keys = np.arange(BANDS, dtype=np.uint64)
    for column in found.reshape(BANDS, BAND).T.astype(np.uint64):
        keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + column)
    return keys


def most_odd_bits(percent: int) -> int:
    """Bits that the sketches of sets of similarity ``percent`` differ in at most, by ``DEVIATIONS``."""
    differing = SAMPLES * (100 - percent) / 100
    spread = math.sqrt(SAMPLES * percent * (100 - percent)) / 100
    decay = math.exp(-4 * differing / BITS)
    # The spread of the number of differing samples, and that of the bits they fall on.
    deviation = math.hypot(2 * decay * spread, math.sqrt(BITS / 4 * (1 - decay * decay)))
    return math.ceil(BITS / 2 * (1 - decay) + DEVIATIONS * deviation)


def similarity(bits: int) -> float:
    """The Jaccard similarity that a number of differing bits stands for."""
    return max(0.0, 1 + BITS / (4 * SAMPLES) * math.log(max(1 - 2 * bits / BITS, 1e-9)))


def _sets(batch: pa.RecordBatch, words: int):
    for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
        yield key, shingles(WORD.findall(fold_ascii(text.as_py() or "")), words)


def _signed(texts: DataFrame, words: int) -> DataFrame:
    """Per row: id, size and 128-bit hash of its set, band keys and odd sketch."""
    names = ["id", "n", "h1", "h2", "bands", *SKETCH]
    kinds = [pa.int64()] * 4 + [pa.list_(pa.int64())] + [pa.int64()] * len(SKETCH)
    nothing = [None] + [0] * len(SKETCH)

    def work(arrived):
        for batch in arrived:
            out = []
            for key, tokens in _sets(batch, words):
                digest = xxhash.xxh3_128_intdigest(tokens.tobytes())
                halves = np.array([digest >> 64, digest & (2**64 - 1)], dtype=np.uint64).view(np.int64).tolist()
                more = nothing
                if len(tokens):
                    found = samples(tokens)
                    more = [band_keys(found).view(np.int64), *odd_sketch(found).view(np.int64).tolist()]
                out.append((key, len(tokens), *halves, *more))
            columns = list(zip(*out)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return texts.mapInArrow(
        work, "id bigint, n bigint, h1 bigint, h2 bigint, bands array<bigint>, " + ", ".join(f"{s} bigint" for s in SKETCH)
    )


def _sets_of(texts: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """The sets of the given ids, whose texts alone are split again."""

    def work(arrived):
        for batch in arrived:
            found = [(key, tokens.view(np.int64)) for key, tokens in _sets(batch, words) if len(tokens)]
            keys, sets = zip(*found) if found else ([], [])
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], ["id", "tokens"])

    return texts.join(ids, "id", "left_semi").mapInArrow(work, "id bigint, tokens array<bigint>")


def _similar_sizes(x: Column, y: Column, percent: int) -> Column:
    return 100 * F.least(x, y) >= percent * F.greatest(x, y)


def _odd_bits(left: str, right: str) -> Column:
    return sum((F.bit_count(F.col(f"{left}.{s}").bitwiseXOR(F.col(f"{right}.{s}"))) for s in SKETCH), F.lit(0))


def _fits(limit: int, first_band: bool):
    """Similar sketches; with ``first_band`` a pair is looked at in the first band it shares only."""

    def of(group: pa.Table):
        sketches = np.stack([group[s].to_numpy().view(np.uint64) for s in SKETCH], axis=1)
        bands = np.stack([b.values.to_numpy() for b in group["bands"]]) if first_band else None
        band = group["band"][0].as_py()

        def fitting(i, near):
            near = near[np.bitwise_count(sketches[near] ^ sketches[i]).sum(axis=1) <= limit]
            if first_band and len(near):
                near = near[bands[i][(bands[near] == bands[i]).argmax(axis=1)] == band]
            return near

        return fitting

    return of


def odd_sketch_components(
    docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", words: int = 5, percent: int = 80
) -> DataFrame:
    """Components of the documents whose sets of word shingles are similar: ``100 * both >= percent * either``.

    Words are runs of what is not ASCII white space, with A-Z lower-cased; fewer than ``words`` words are one shingle.
    Returns one row per id: the id, ``n_shingles``, ``component_id`` (the smallest id reachable by links) and ``kept``,
    whether that is the id itself.

    Equal sets are put together first, so copies cost one row each. Members of a band are compared with centres, one row
    per member, which joins most groups of near copies. Bands whose members are then still in several components are
    compared in blocks: by sketches first, which names the members with a possible partner, then on the sets of
    those alone. Tasks hand on no more rows than they have members, whatever the number of pairs.

    Every link handed on is exact. A link is missed if a pair shares no band (1.2e-7 at a similarity of 0.8, less above)
    or its sketches differ by ``DEVIATIONS`` standard deviations more than expected.

    A null or empty text has no shingles and is linked with nothing. A null id is one id above all others. Rows of
    one id with different texts are one node with the links of each; ``n_shingles`` is the largest. Rows given several
    times are one. An empty table gives an empty result.
    """
    prepared(docs.sparkSession)
    limit = most_odd_bits(percent)
    texts = docs.select(id_key(id_column).alias("id"), F.col(text_column).alias("text"))
    signed = materialized(_signed(texts, words), "signed")
    digest = ["n", "h1", "h2"]
    first = materialized(signed.where("n > 0").groupBy(*digest).agg(F.min("id").alias("first")), "first")
    nodes = materialized(signed.select("id", *digest).join(first, digest, "left").select("id", "n", "first"), "nodes")
    leaders = materialized(
        signed.join(first, digest).where("id = first").dropDuplicates(["id", *digest]).drop("h1", "h2", "first"), "leaders"
    )
    members = leaders.select("id", F.explode("bands").alias("band"))
    # A centre is the least by one of a few hashes, chosen by the band.
    draw = F.xxhash64("id", F.pmod("band", F.lit(CENTRES)))
    centres = members.groupBy("band").agg(F.min(F.struct(draw.alias("draw"), "id")).alias("c"), F.count("*").alias("size"))
    centres = materialized(centres.where("size > 1").select("band", F.col("c.id").alias("centre")), "centres")
    members = materialized(members.join(centres, "band"), "members")

    star = members.where("id <> centre").select(F.col("id").alias("a"), F.col("centre").alias("b")).distinct()
    sketches = leaders.select("id", "n", *SKETCH)
    both = star.join(sketches.alias("x"), F.col("a") == F.col("x.id")).join(sketches.alias("y"), F.col("b") == F.col("y.id"))
    near = both.where(_similar_sizes(F.col("x.n"), F.col("y.n"), percent) & (_odd_bits("x", "y") <= limit))
    near = materialized(near.select(*ordered_pair("x", "y")).distinct(), "star")
    sets = stored_sets(near.selectExpr("explode(array(a, b)) as id"), lambda ids: _sets_of(texts, ids, words))
    links = materialized(verified_by_sets(near, sets, percent).distinct(), "links")

    joined = components(links).withColumnRenamed("node", "id")
    held = members.join(joined, "id", "left").select("band", "id", F.coalesce("component", "id").alias("component"))
    held = materialized(held, "held")
    still = held.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    still = materialized(still.where("low <> high").select("band"), "open")
    rest = materialized(held.join(still, "band").join(sketches, "id"), "rest")
    partners = materialized(with_partner(rest, ["band"], percent, _fits(limit, False)), "partners")
    sets = stored_sets(partners.select("id"), lambda ids: _sets_of(texts, ids, words))
    full = rest.join(partners, ["band", "id"], "left_semi").join(leaders.select("id", "n", "bands"), ["id", "n"]).join(sets, "id")
    # Of an id with several texts, each set goes with its own bands.
    further = materialized(block_links(full.where("size(tokens) = n"), ["band"], percent, _fits(limit, True)), "links")

    # An id with several texts joins the sets of all of them.
    own = nodes.where("first is not null").select("id", "first").distinct()
    several = own.groupBy("id").agg(F.min("first").alias("a"), F.max("first").alias("high")).where("a <> high")
    same = own.join(several, "id").select("a", F.col("first").alias("b"))
    found = components(links.union(further).union(same))
    whole = nodes.join(found, nodes["first"] == found["node"], "left").groupBy("id").agg(
        F.max("n").alias("n"), F.min(F.coalesce("component", "first", "id")).alias("component")
    )
    return whole.select(
        F.when(F.col("id") != NULL_ID, F.col("id")).alias(id_column), F.col("n").alias("n_shingles"),
        F.col("component").alias("component_id"), (F.col("component") == F.col("id")).alias("kept"),
    )
