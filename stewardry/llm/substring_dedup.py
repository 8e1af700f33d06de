"""Removal of repeated passages: every window of words that an earlier document has.

Windows have Rabin-Karp hashes. They are counted in Spark in two steps that lose
none: first by unit (see ``passages``), which settles windows of units that are
equal as a whole, then window by window for the units that share an anchor yet
differ. Of those only the first document with the unit is looked at, as the
others lose it as a whole. What repeats is merged to maximal intervals.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stewardry.llm import passages
from stewardry.llm.staging import staged
from stewardry.llm.texts import signed, texts_of, word_hashes

WIDTH = 50
# Words of an anchor. Longer ones repeat less by chance, shorter ones are fewer.
GRAM = 16


def _rows(documents: DataFrame, text: str, key: str) -> DataFrame:
    """``doc, version, text``: rows of one key and text are one document."""
    return documents.select(F.col(key).alias("doc"), F.xxhash64(text).alias("version"), F.col(text).alias("text"))


def find_units(rows: DataFrame, width: int, gram: int) -> DataFrame:
    """``doc, version, anchor, content, low, high`` of every unit of every text."""
    kind = rows.schema["doc"].dataType.simpleString()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, owner = [], []
            for i, text in enumerate(texts_of(batch.column("text"))):
                one = passages.units(word_hashes(text), width, gram)
                if len(one[0]):
                    found.append(one)
                    owner.append(np.full(len(one[0]), i))
            if not found:
                continue
            anchor, content, low, high, _ = (np.concatenate(c) for c in zip(*found))
            at = pa.array(np.concatenate(owner))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc").take(at), batch.column("version").take(at), pa.array(signed(anchor)),
                    pa.array(signed(content)), pa.array(low.astype(np.int32)), pa.array(high.astype(np.int32)),
                ],
                ["doc", "version", "anchor", "content", "low", "high"],
            )

    return rows.where("doc IS NOT NULL").mapInArrow(
        find, f"doc {kind}, version long, anchor long, content long, low int, high int"
    )


def expand(rows: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """``doc, version, start, high_hash, low_hash`` of each window of the wanted units."""
    kind = rows.schema["doc"].dataType.simpleString()
    lists = wanted.groupBy(F.col("doc").alias("_doc"), F.col("version").alias("_version")).agg(
        F.collect_list("low").alias("lows"), F.collect_list("high").alias("highs")
    )
    joined = rows.join(lists, (F.col("doc") == F.col("_doc")) & (F.col("version") == F.col("_version")))

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lows, highs = batch.column("lows").to_pylist(), batch.column("highs").to_pylist()
            for i, text in enumerate(texts_of(batch.column("text"))):
                values = word_hashes(text)
                parts = [(np.arange(a, b + 1), *passages.window_hashes(values, a, b, width)) for a, b in zip(lows[i], highs[i])]
                start, one, two = (np.concatenate(c) for c in zip(*parts))
                at = pa.array(np.full(len(start), i))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc").take(at), batch.column("version").take(at),
                        pa.array(start.astype(np.int32)), pa.array(signed(one)), pa.array(signed(two)),
                    ],
                    ["doc", "version", "start", "one", "two"],
                )

    columns = joined.select("doc", "version", "text", "lows", "highs")
    return columns.mapInArrow(windows, f"doc {kind}, version long, start int, one long, two long")


def repeated_spans(rows: DataFrame, width: int, gram: int) -> DataFrame:
    """``doc, version, start, end`` of words that an earlier document has too."""
    units = staged(find_units(rows, width, gram), "units")
    contents = units.groupBy("anchor", "content").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
    # Anchors with several contents, in several documents.
    mixed = contents.groupBy(F.col("anchor").alias("_mixed")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("first").alias("_least"), F.max("first").alias("_most")
    )
    mixed = mixed.where("_n > 1 AND _least < _most").select("_mixed")
    flagged = contents.join(mixed, F.col("anchor") == F.col("_mixed"), "left")
    flagged = flagged.where("first < last OR _mixed IS NOT NULL").select(
        F.col("anchor").alias("_anchor"), F.col("content").alias("_content"), "first", F.col("_mixed").isNotNull().alias("mixed")
    )
    same = (F.col("anchor") == F.col("_anchor")) & (F.col("content") == F.col("_content"))
    touched = staged(units.join(flagged, same).drop("_anchor", "_content"), "touched")
    whole = touched.where("doc > first")
    whole = whole.select("doc", "version", F.col("low").alias("start"), (F.col("high") + width).alias("end"))
    wanted = touched.where("mixed AND doc = first")
    windows = staged(expand(rows, wanted, width), "windows")
    firsts = windows.groupBy(F.col("one").alias("_one"), F.col("two").alias("_two")).agg(
        F.min("doc").alias("_first"), F.max("doc").alias("_last")
    )
    firsts = firsts.where("_first < _last")
    equal = (F.col("one") == F.col("_one")) & (F.col("two") == F.col("_two"))
    single = windows.join(firsts, equal).where(F.col("doc") > F.col("_first"))
    single = single.select("doc", "version", "start", (F.col("start") + width).alias("end"))
    return whole.unionByName(single)


def remove_repeats(
    documents: DataFrame, width: int = WIDTH, text: str = "text", key: str = "doc_id", gram: int = GRAM
) -> DataFrame:
    """``key, n_words, n_removed, kept_sha256`` of every document.

    A word goes if any window of ``width`` words over it also starts in a
    document with a smaller key. Null or empty text: no words, and the digest of
    nothing. A null key is smaller than none and has none before it. Rows of one
    key don't remove from each other; a repeated row comes back as often.
    """
    rows = _rows(documents, text, key)
    kind = rows.schema["doc"].dataType.simpleString()
    spans = repeated_spans(rows, width, gram)
    lists = spans.groupBy(F.col("doc").alias("_doc"), F.col("version").alias("_version")).agg(
        F.collect_list("start").alias("starts"), F.collect_list("end").alias("ends")
    )
    # A null key has no spans; the version spreads such rows.
    joined = rows.join(lists, (F.col("version") == F.col("_version")) & (F.col("doc") == F.col("_doc")), "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts, ends = batch.column("starts").to_pylist(), batch.column("ends").to_pylist()
            sizes, removed, digests = [], [], []
            for text, a, b in zip(texts_of(batch.column("text")), starts, ends):
                words = text.tobytes().split()
                gone = passages.covered(len(words), list(zip(a or (), b or ())))
                kept = [w for w, g in zip(words, gone.tolist()) if not g] if a else words
                sizes.append(len(words))
                removed.append(len(words) - len(kept))
                digests.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())],
                ["doc", "n_words", "n_removed", "kept_sha256"],
            )

    columns = joined.select("doc", "text", "starts", "ends")
    out = columns.mapInArrow(cut, f"doc {kind}, n_words long, n_removed long, kept_sha256 string")
    return out.withColumnRenamed("doc", key)
