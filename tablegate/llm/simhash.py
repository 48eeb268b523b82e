"""SimHash near-duplicates: fingerprints linked within a few bits, grouped into components.

Pairs come from a pivot distance table. Its references are the zero fingerprint, the 64
fingerprints with one bit, and a set of dense fingerprints. Two fingerprints within k bits
agree in all distances relative to zero to the one-bit references of some bands: with b
bands at most k can differ, so every choice of b - k bands that agree is a join key. Among
the fingerprints that meet under a key, pairs whose distances to a dense reference differ by
more than k are discarded (triangle inequality), and the survivors are verified.

Defined cases: a null or wordless text has fingerprint 0 and links like any other; null
doc_ids are ignored when the smallest doc_id is looked for; repeated rows share their
fingerprint and component; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablegate.llm.common import content_hash, packed, small_or_shuffled, text_of
from tablegate.llm.components import components
from tablegate.llm.runs import in_units, spanning_pairs
from tablegate.session import materialize

SHINGLE = 3
MAX_BITS = 3
BANDS = 6
DENSE_PIVOTS = 8
SEED = 42


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64 bits: bit i is set if it is set in over half of the shingles' XXH64 values."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = [digest(b" ".join(words), SEED)]
    else:
        # Shingles are slices of the single-spaced text.
        joined = b" ".join(words)
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
        ends = np.cumsum(lengths) - 1
        starts = ends - lengths + 1
        count = len(words) - shingle + 1
        hashes = [
            digest(joined[a:b], SEED)
            for a, b in zip(starts[:count].tolist(), ends[shingle - 1 :].tolist())
        ]
    set_bits = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):
        block = np.array(hashes[at : at + 65536], "<u8")
        bits = np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int64)
    over = set_bits * 2 > len(hashes)
    return int(np.packbits(over, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, content, fingerprint) for every row; the fingerprint is a signed long."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(text.as_py(), shingle) for text in batch.column("text")]
            prints = pa.array(np.array(values, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("content"), prints],
                names=["doc_id", "content", "fingerprint"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", content_hash(text_of()).alias("content"), "text")
    return rows.mapInArrow(compute, f"doc_id {kind}, content long, fingerprint long")


def band_edges(bands: int = BANDS) -> list[int]:
    return [64 * i // bands for i in range(bands + 1)]


def pivots(count: int = DENSE_PIVOTS) -> list[int]:
    """Dense reference fingerprints, the XXH64 of their number."""
    return [xxhash.xxh64_intdigest(str(i).encode(), SEED) for i in range(count)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def distance_table(prints: DataFrame, dense: int = DENSE_PIVOTS) -> DataFrame:
    """(fingerprint, dense distances packed in one long of 8 bits each)."""
    packed = F.lit(0).cast("long")
    for i, pivot in enumerate(pivots(dense)):
        distance = F.bit_count(F.col("fingerprint").bitwiseXOR(F.lit(_signed(pivot)))).cast("long")
        packed = packed.bitwiseOR(F.shiftleft(distance, 8 * i))
    return prints.select("fingerprint", packed.alias("distances"))


def candidate_rows(
    prints: DataFrame, max_bits: int = MAX_BITS, bands: int = BANDS
) -> DataFrame:
    """(key, fingerprint, distances): a row for each choice of bands that may agree.

    The distances to zero and to the one-bit references of a band, relative to each other,
    are the band's bits; so a key is the fingerprint masked to the chosen bands.
    """
    edges = band_edges(bands)
    masks = []
    for chosen in itertools.combinations(range(bands), bands - max_bits):
        mask = 0
        for band in chosen:
            mask |= ((1 << (edges[band + 1] - edges[band])) - 1) << edges[band]
        masks.append(mask)
    keys = [
        F.xxhash64(F.lit(i), F.col("fingerprint").bitwiseAND(F.lit(_signed(mask))))
        for i, mask in enumerate(masks)
    ]
    return prints.select(F.explode(F.array(*keys)).alias("key"), "fingerprint", "distances")


def links(
    prints: DataFrame, max_bits: int = MAX_BITS, bands: int = BANDS, dense: int = DENSE_PIVOTS
) -> DataFrame:
    """(a, b): fingerprints within ``max_bits``, enough of them to span each component.

    Blocks of a key that hold many fingerprints give a spanning set of their links, not
    all of them.
    """
    rows = in_units(candidate_rows(distance_table(prints, dense), max_bits, bands))

    def near(columns: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
        packed = columns["distances"]
        close = np.ones(len(x), bool)
        for i in range(dense):
            at = packed >> (8 * i) & 255
            close &= np.abs(at[x] - at[y]) <= max_bits
        survivors = np.flatnonzero(close)
        prints = columns["fingerprint"].view(np.uint64)
        apart = np.bitwise_count(prints[x[survivors]] ^ prints[y[survivors]])
        close[survivors] = apart <= max_bits
        return close

    return spanning_pairs(rows, "fingerprint", near).distinct()


def marked_groups(
    docs: DataFrame, shingle: int, max_bits: int, bands: int, dense: int
) -> tuple[DataFrame, DataFrame]:
    """The rows' fingerprints, and (fingerprint, component) of every distinct fingerprint."""
    marked = materialize(fingerprints(docs, shingle))
    prints = marked.select("fingerprint").distinct()
    linked = components(links(prints, max_bits, bands, dense))
    linked = linked.select(F.col("node").alias("fingerprint"), "component")
    groups = prints.join(linked, "fingerprint", "left")
    return marked, groups.select("fingerprint", F.coalesce("component", "fingerprint").alias("component"))


def near_duplicates(
    docs: DataFrame,
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
    bands: int = BANDS,
    dense: int = DENSE_PIVOTS,
) -> DataFrame:
    """(doc_id, fingerprint as 16 hex digits, component_id) for every row.

    component_id is the smallest doc_id that can be reached over links.
    """
    marked, groups = marked_groups(docs, shingle, max_bits, bands, dense)
    smallest = marked.groupBy("fingerprint").agg(F.min("doc_id").alias("smallest"))
    roots = materialize(groups.join(smallest, "fingerprint"))
    ids = roots.groupBy("component").agg(F.min("smallest").alias("component_id"))
    # One row for each distinct fingerprint: only the documents' side can be hot.
    known = roots.join(ids, "component").select("fingerprint", "component_id")
    return marked.join(known, "fingerprint").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def keep_one(
    docs: DataFrame,
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
    bands: int = BANDS,
    dense: int = DENSE_PIVOTS,
) -> DataFrame:
    """One document of each component: that of the smallest doc_id, a null one first."""
    marked, groups = marked_groups(docs, shingle, max_bits, bands, dense)
    first = F.min(F.struct("doc_id", "content"))
    own = marked.groupBy("fingerprint").agg(first.alias("first"))
    stay = own.join(groups, "fingerprint").groupBy("component").agg(F.min("first").alias("first"))
    stay = materialize(stay.select("first.*"))
    keys = small_or_shuffled(stay)
    rows = packed(docs).withColumn("text_hash", content_hash(text_of("row.text")))

    def same(keys: DataFrame):
        return rows["row.doc_id"].eqNullSafe(keys["doc_id"]) & (rows["text_hash"] == keys["content"])

    kept = rows.join(keys, same(keys), "left_semi")
    repeated = materialize(
        marked.groupBy("doc_id", "content").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    )
    if repeated.limit(1).count():
        # Rows that repeat doc_id and text are one document; only they are shuffled.
        again = small_or_shuffled(repeated)
        single = kept.join(again, same(again), "left_anti")
        one = kept.join(again, same(again), "left_semi").withColumn("id", F.col("row.doc_id"))
        kept = single.union(one.dropDuplicates(["id", "text_hash"]).drop("id"))
    return kept.select("row.*")
