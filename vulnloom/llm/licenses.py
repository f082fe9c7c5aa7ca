"""License scans: base phrases, and templates found by an exact set-similarity join."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from math import ceil

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vulnloom.llm.common import batches, id_text_rows, id_texts, staged
from vulnloom.llm.license_texts import NOTICES, PHRASES

THRESHOLD = 0.8
# A block is at least this long, so a notice of a few words is not put together from afar.
LEAST_REACH = 4

_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def needed(n: int, threshold: float = THRESHOLD) -> int:
    """Words of a template of n distinct words that a block must hold."""
    return ceil(round(threshold * n, 9))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORD_BYTES).split()


def reach(n_words: int, threshold: float = THRESHOLD) -> int:
    """Words over which a template of ``n_words`` words in all may be spread and is surely found."""
    return max(LEAST_REACH, ceil(round(n_words / threshold, 9)))


def n_blocks(n_words: int, size: int) -> int:
    """Blocks of a text: runs of twice ``size`` words, each ``size`` after the one before, whatever
    the line ends; so every run of ``size`` words lies in one of them."""
    return max(ceil((n_words - size) / size), 1)


def base_places(words: list[bytes], phrases: list[tuple[str, str]] = PHRASES) -> list[tuple[int, str]]:
    """(first word, label) wherever the words of a base phrase stand one after another."""
    run = b" " + b" ".join(words) + b" "
    found = []
    for phrase, label in phrases:
        own = b" " + phrase.encode() + b" "
        at, before, upto = run.find(own), 0, 0
        while at >= 0:
            before, upto = before + run.count(b" ", upto, at), at
            found.append((before, label))
            at = run.find(own, at + 1)
    return found


def summary(places: list[tuple[int, str]]) -> tuple[int, int | None, int | None, list[str]]:
    """How many places there are, the first and the last, and their distinct labels."""
    at = [a for a, _ in places]
    return len(at), min(at, default=None), max(at, default=None), sorted({label for _, label in places})


def frequencies(docs: DataFrame, vocabulary: frozenset[bytes]) -> dict[bytes, int]:
    """How often each word of the templates stands in all documents.

    Counts are combined per task, and the driver gets one per template word.
    """

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: Counter[bytes] = Counter()
        for _, text in id_text_rows(parts):
            count.update(w for w in words_of(text) if w in vocabulary)
        yield from batches(count.items(), pa.schema([("word", pa.binary()), ("n", pa.int64())]))

    rows = id_texts(docs).mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {bytes(r["word"]): r["n"] for r in rows.collect()}


def scan(docs: DataFrame, templates: list[tuple[str, str]] | None = None, threshold: float = THRESHOLD,
         phrases: list[tuple[str, str]] = PHRASES) -> DataFrame:
    """Labels of every document, those of base ``phrases``, of ``PHRASES`` and of ``templates``.

    Base columns tell of ``phrases`` alone; whatever those are, ``PHRASES`` are looked for too
    and give labels.

    Blocks are half-overlapping runs of words over the whole document, across line ends, and
    as long as the template needs (``reach``): wherever a run of that many words holds
    ``threshold`` of its distinct words, a block does. Templates of one length share blocks.
    Words are ordered by their frequency over all documents, rarest first. A block can only
    reach the threshold if it holds one of the first words of a template (prefix filter), has
    words enough (length filter) and enough left after the first shared one (positional
    filter); what passes is verified.

    Returns doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score:
    1 where a base phrase or one of ``PHRASES`` stands, else the largest containment found,
    else 0; then n_phrases, first_phrase, last_phrase and phrase_labels, which are for
    ``PHRASES`` what the base columns are for ``phrases``. A null or empty text has no words,
    labels '' and score 0. Rows that repeat a doc_id are returned each; a row without doc_id
    takes no part; an empty table gives no rows.
    """
    spark = docs.sparkSession
    wording = []
    for label, text in templates or NOTICES:
        words = words_of(text.encode())
        wording.append((label, sorted(set(words)), reach(len(words), threshold)))
    vocabulary = frozenset(w for _, words, _ in wording for w in words)
    seen = frequencies(docs, vocabulary)
    order = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (seen.get(w, 0), w)))}
    prefix = []
    # Of each length of blocks, the words that matter and those that open a prefix.
    every: dict[int, set[bytes]] = {}
    first: dict[int, set[bytes]] = {}
    for number, (label, words, size) in enumerate(wording):
        ranked, least = sorted(words, key=order.get), needed(len(words), threshold)
        every.setdefault(size, set()).update(words)
        first.setdefault(size, set()).update(ranked[:len(words) - least + 1])
        for i in range(len(words) - least + 1):
            prefix.append((order[ranked[i]], size, number, i, len(words), least, label, [order[w] for w in ranked]))
    any_first = frozenset().union(*first.values())

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 40
        schema = pa.schema([
            ("row", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()),
            ("first_word", pa.int64()), ("last_word", pa.int64()), ("base", pa.list_(pa.string())),
            ("n_phrases", pa.int64()), ("first_phrase", pa.int64()), ("last_phrase", pa.int64()), ("general", pa.list_(pa.string())),
            ("blocks", pa.list_(pa.struct([("reach", pa.int32()), ("size", pa.int32()), ("words", pa.list_(pa.int32()))])))])

        def rows():
            for number, (doc_id, text) in enumerate(id_text_rows(parts)):
                words = words_of(text)
                held = []
                hits = [] if any_first.isdisjoint(words) else [(i, w) for i, w in enumerate(words) if w in any_first]
                for size in first if hits else ():
                    last = n_blocks(len(words), size) - 1
                    near = {min(b, last) for i, w in hits if w in first[size] for b in (i // size, max(i // size - 1, 0))}
                    for b in sorted(near):
                        block = set(words[b * size:(b + 2) * size])
                        own = sorted(order[w] for w in every[size] & block)
                        held.append({"reach": size, "size": len(block), "words": own})
                yield (base + number, doc_id, len(words), *summary(base_places(words, phrases)),
                       *summary(base_places(words)), held)

        yield from batches(rows(), schema, 2048)

    own = staged(id_texts(docs).mapInArrow(
        run, "row long, doc_id long, n_words long, n_base long, first_word long, last_word long, base array<string>, "
             "n_phrases long, first_phrase long, last_phrase long, general array<string>, "
             "blocks array<struct<reach: int, size: int, words: array<int>>>"), "license-blocks")
    # One row per prefix word of the templates: a table of fixed size.
    index = F.broadcast(spark.createDataFrame(
        prefix, "word int, reach int, template int, i int, n int, least int, label string, wording array<int>"))
    held = own.select("row", F.posexplode("blocks").alias("block", "b")).select("row", "block", "b.reach", "b.size", "b.words")
    pairs = (held.select("row", "block", "reach", "size", "words", F.posexplode("words").alias("j", "word"))
             .join(index, ["word", "reach"])
             .where("size >= least")
             .where("1 + least(n - i - 1, size(words) - j - 1) >= least OR i > 0"))
    found = (pairs.groupBy("row", "block", "template")
             .agg(F.min("i").alias("i"), F.min("j").alias("j"), F.first("n").alias("n"), F.first("least").alias("least"),
                  F.first("label").alias("label"), F.first("words").alias("words"), F.first("wording").alias("wording"))
             .where("1 + least(n - i - 1, size(words) - j - 1) >= least")
             .withColumn("shared", F.size(F.array_intersect("words", "wording")))
             .where("shared >= least")
             .groupBy("row").agg(F.collect_set("label").alias("more"), F.max(F.col("shared") / F.col("n")).alias("held")))
    both = F.array_sort(F.array_distinct(F.concat("base", "general", F.coalesce("more", F.array().cast("array<string>")))))
    return own.drop("blocks").join(found, "row", "left").select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("base", ",").alias("base_labels"), F.array_join(both, ",").alias("labels"),
        F.when(F.expr("n_base > 0 OR n_phrases > 0"), F.lit(1.0)).otherwise(F.coalesce("held", F.lit(0.0))).alias("score"),
        "n_phrases", "first_phrase", "last_phrase", F.array_join("general", ",").alias("phrase_labels"))
