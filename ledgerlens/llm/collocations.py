"""Phrases that occur more often than their parts suggest: Toivonen's sampling, exact counts, exact scores."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.session import staged
from .common import numbers, parts
from .lookup import sliced
from .shingles import mix

LEAST = 100  # occurrences of a candidate
LONGEST = 5  # words of a candidate
FIRST = 2000  # phrases reported of a language
SAMPLE = 0.125  # share of the documents that propose phrases
SLACK = 0.4  # of what the sample should hold of a phrase with LEAST occurrences; it misses one with probability 0.005
BITS = 1 << 25  # of the filter of proposed phrases; beyond some million phrases it lets more through, which costs time only

# What parts words, what parts pieces
SPACES = b"\x20\x09"
BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"

STEP = 3 << 19  # bytes of text worked on at once

_ODD = np.uint64(0x9E3779B97F4A7C15)
_ROWS = 1 << 16  # rows of a batch given out
_COUNTS = "lang string, words int, phrase string, bucket long, n long"
_NAMES = ["lang", "words", "phrase", "bucket", "n"]


def _tables() -> tuple[np.ndarray, np.ndarray]:
    low, kind = np.arange(256, dtype=np.uint8), np.zeros(256, np.uint8)
    low[65:91] += 32
    kind[list(SPACES)], kind[list(BREAKS)] = 1, 2
    return low, kind


_LOW, _KIND = _tables()


def _hashes(texts: Iterable[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(t) for t in texts), np.uint64)


def _spun(lang: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(word + lang * _ODD)


def _longer(head: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The hash of a phrase out of that of all but its last word, and that of its last word."""
    return mix(head * _ODD + last)


def _places(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return tuple((x & np.uint64(BITS - 1)).astype(np.int64) for x in (h, h >> np.uint64(32)))


def _bucket(h: np.ndarray, width: int) -> np.ndarray:
    return (h >> np.uint64(64 - width)).astype(np.int64)


def _of_bucket(bucket: np.ndarray) -> np.ndarray:
    """A bucket in the place of a phrase's hash."""
    return mix(bucket.view(np.uint64) + _ODD)


def _open(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Whether phrases are in the filter: surely if they were put in, by chance otherwise."""
    one, two = _places(h)
    return ((bits[one >> 3] >> (one & 7).astype(np.uint8)) & (bits[two >> 3] >> (two & 7).astype(np.uint8)) & 1).astype(bool)


class Phrases(NamedTuple):
    """The distinct phrases of one length in some texts."""

    length: int
    first: np.ndarray  # a place of each
    n: np.ndarray
    hash: np.ndarray
    proposed: np.ndarray
    known: np.ndarray  # part of the pass that counts the proposed ones and their border
    failed: np.ndarray  # of a bucket of the border that is frequent


class Words:
    """The words of some texts, numbered by (language, word), with where pieces end."""

    def __init__(self, langs: list[str], texts: list[bytes]):
        raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        kind = _KIND[raw]
        inner = kind == 0
        edge = np.flatnonzero(np.diff(np.concatenate([[False], inner, [False]]).astype(np.int8)))
        begin, end = edge[::2], edge[1::2]
        piece = np.cumsum(kind == 2, dtype=np.int32)[begin] if len(begin) else np.zeros(0, np.int32)
        self.joined = piece[1:] == piece[:-1]  # a word and the next are of one piece
        ends = np.concatenate([[0], np.cumsum(end - begin)]).astype(np.int64)
        flat = pa.LargeStringArray.from_buffers(len(begin), pa.py_buffer(ends), pa.py_buffer(_LOW[raw[inner]]))
        coded = flat.dictionary_encode()
        self.texts = coded.dictionary
        text_starts = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])[:-1]
        self.langs = list(dict.fromkeys(langs))
        code = {name: i for i, name in enumerate(self.langs)}
        lang_of = np.array([code[name] for name in langs], np.int64)
        lang = lang_of[np.searchsorted(text_starts, begin, side="right") - 1] if len(begin) else np.zeros(0, np.int64)
        both, self.word = np.unique(lang * len(self.texts) + coded.indices.to_numpy(), return_inverse=True)
        self.text, self.lang = both % max(1, len(self.texts)), both // max(1, len(self.texts))
        self.count = np.bincount(lang, minlength=len(self.langs))
        self.hash = _spun(_hashes(self.langs)[self.lang], _hashes(self.texts.to_pylist())[self.text]) if len(both) else np.zeros(0, np.uint64)

    def phrases(self, longest: int, bits: np.ndarray | None, found: np.ndarray | None = None, width: int = 64) -> Iterator[Phrases]:
        """For each length the distinct phrases that may be frequent.

        Without ``found`` these are the ones whose two parts of one word less are proposed (in ``bits``): the proposed phrases and
        their border. With ``found``, what a pass over those has shown to be frequent, they are the ones whose parts are found, or
        weren't part of that pass (``known`` is false).
        """
        n = len(self.word)
        at, key, hashed = np.arange(n), self.word, self.hash  # where phrases begin, their number, the hash of each number
        first, known = np.empty(len(self.hash), np.int64), np.ones(len(self.hash), bool)
        first[self.word] = at
        for length in range(1, longest + 1):
            if length > 1:
                here, was, number = np.zeros(n, bool), np.zeros(n, bool), np.zeros(n, np.int64)
                here[at], was[at], number[at] = live[key], (known & proposed)[key], key
                after = here[1:] & here[:-1]
                if length == 2:
                    after &= self.joined
                at = np.flatnonzero(after)
                wide = number[at] * len(self.hash) + self.word[at + length - 1]
                order = np.argsort(wide)
                new = np.concatenate([[True], np.diff(wide[order]) != 0]) if len(wide) else np.zeros(0, bool)
                key = np.empty(len(at), np.int64)
                key[order] = np.cumsum(new) - 1
                first = at[order[new]]
                known = was[first] & was[first + 1]
                hashed = _longer(hashed[number[first]], self.hash[self.word[first + length - 1]])
            proposed = _open(bits, hashed) if bits is not None else np.zeros(len(first), bool)
            failed = _open(found, _of_bucket(_bucket(hashed, width))) if found is not None else np.zeros(len(first), bool)
            live = proposed if found is None else ~known | np.where(proposed, _open(found, hashed), failed)
            yield Phrases(length, first, np.bincount(key, minlength=len(first)), hashed, proposed, known, failed)

    def spelt(self, first: np.ndarray, length: int) -> pa.Array:
        texts = [self.texts.take(pa.array(self.text[self.word[first + i]])) for i in range(length)]
        return texts[0] if len(texts) == 1 else pc.binary_join_element_wise(*texts, pa.scalar(" ", pa.large_string()))


def _stretches(texts: pa.Array) -> Iterator[tuple[int, bytes]]:
    """(row, part) of every text, cut where pieces end so that a part has about ``STEP`` bytes, however long the text."""
    for row, text in enumerate(texts.to_pylist()):
        held = (text or "").encode()
        while len(held) > STEP:
            cut = max(held.rfind(bytes([b]), 0, STEP) for b in BREAKS)
            if cut < 0:  # a piece longer than that: it stays whole
                cut = min((p for b in BREAKS if (p := held.find(bytes([b]), STEP)) >= 0), default=len(held))
            yield row, held[:cut]
            held = held[cut + 1 :]
        yield row, held


def _slices(batches) -> Iterator[Words]:
    for batch in sliced(batches, "text", STEP):
        langs = batch.column("lang").to_pylist()
        rows, texts, held = [], [], 0
        for row, part in [*_stretches(batch.column("text")), (None, b"")]:
            if texts and (row is None or held + len(part) > STEP):
                yield Words([langs[r] for r in rows], texts)
                rows, texts, held = [], [], 0
            if row is not None:
                rows.append(row)
                texts.append(part)
                held += len(part)


def _given(words: Words, phrases: Phrases, chosen: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows of the chosen phrases as they are."""
    names = pa.array(words.langs, pa.string())
    first, n = phrases.first[chosen], phrases.n[chosen]
    for a in range(0, len(n), _ROWS):
        part = first[a : a + _ROWS]
        lang, size = names.take(pa.array(words.lang[words.word[part]])), len(part)
        columns = [lang, pa.array(np.full(size, phrases.length, np.int32)), words.spelt(part, phrases.length).cast(pa.string()), pa.nulls(size, pa.int64()), pa.array(n[a : a + _ROWS], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, _NAMES)


def _in_buckets(phrases: Phrases, chosen: np.ndarray, width: int) -> Iterator[pa.RecordBatch]:
    """Rows of the chosen phrases by bucket."""
    buckets, n = _bucket(phrases.hash[chosen], width), phrases.n[chosen]
    for a in range(0, len(n), _ROWS):
        part = buckets[a : a + _ROWS]
        size = len(part)
        yield pa.RecordBatch.from_arrays([pa.nulls(size, pa.string()), pa.nulls(size, pa.int32()), pa.nulls(size, pa.string()), pa.array(part), pa.array(n[a : a + _ROWS], pa.int64())], _NAMES)


def _totals(words: Words) -> pa.RecordBatch:
    """The number of words of each language, as rows of 0 words."""
    size = len(words.langs)
    return pa.RecordBatch.from_arrays([pa.array(words.langs, pa.string()), pa.array([0] * size, pa.int32()), pa.array([""] * size), pa.nulls(size, pa.int64()), pa.array(words.count, pa.int64())], _NAMES)


def _of_length(shared, length: int):
    """Every phrase of one length whose parts are proposed."""

    def run(batches):
        bits, _ = shared.value
        for words in _slices(batches):
            if length == 1:
                yield _totals(words)
            for p in words.phrases(length, bits):
                if p.length == length:
                    yield from _given(words, p, np.ones(len(p.n), bool))

    return run


def _with_border(shared, longest: int, width: int):
    """The proposed phrases, and their border by bucket."""

    def run(batches):
        bits, _ = shared.value
        for words in _slices(batches):
            yield _totals(words)
            for p in words.phrases(longest, bits):
                yield from _given(words, p, p.proposed)
                yield from _in_buckets(p, ~p.proposed, width)

    return run


def _beyond(shared, longest: int, width: int):
    """The phrases of failed buckets, and all that may be frequent and was neither proposed nor of the border."""

    def run(batches):
        bits, found = shared.value
        for words in _slices(batches):
            for p in words.phrases(longest, bits, found, width):
                yield from _given(words, p, ~p.known | ~p.proposed & p.failed)

    return run


def _counts(docs: DataFrame, of, *args, bits: np.ndarray | None, found: np.ndarray | None = None) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast((bits, found))  # two filters of fixed size
    return docs.mapInArrow(of(shared, *args), _COUNTS).groupBy("lang", "words", "phrase", "bucket").agg(F.sum("n").alias("n"))


def _marked(batches):
    """lang, phrase, bucket -> the words of the filter's bits that stand for the phrase, or else the bucket."""
    for batch in batches:
        whole = batch.filter(pc.is_valid(batch.column("phrase")))
        langs = _hashes(whole.column("lang").to_pylist())
        split = [p.split(" ") for p in whole.column("phrase").to_pylist()]
        sizes = np.array([len(s) for s in split], np.int64)
        hashes = [_of_bucket(numbers(batch.column("bucket").drop_null()))]
        for size in np.unique(sizes):
            rows = np.flatnonzero(sizes == size)
            h = _spun(langs[rows], _hashes(split[r][0] for r in rows))
            for i in range(1, size):
                h = _longer(h, _spun(langs[rows], _hashes(split[r][i] for r in rows)))
            hashes.append(h)
        at = np.concatenate(_places(np.concatenate(hashes)))
        bit = np.uint64(1) << (at & 63).astype(np.uint64)
        yield pa.RecordBatch.from_arrays([pa.array(at >> 6), pa.array(bit.view(np.int64))], ["at", "bits"])


def _with(bits: np.ndarray | None, phrases: DataFrame) -> np.ndarray:
    """The filter with more phrases in it. Spark puts it together; at most BITS / 64 numbers reach the driver."""
    marked = phrases.select("lang", "phrase", "bucket").mapInArrow(_marked, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits"))
    table = marked.toArrow()
    out = np.zeros(BITS // 64, np.int64) if bits is None else bits.view(np.int64).copy()
    np.bitwise_or.at(out, table.column("at").to_numpy(), table.column("bits").to_numpy())
    return out.view(np.uint8)


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, sample: float = SAMPLE, slack: float = SLACK) -> DataFrame:
    """lang, words, phrase, n: every phrase of at most ``longest`` words with ``least`` or more occurrences, with its exact count;
    and for each language a row of 0 words with the number of all its words. ``docs``: lang, text.

    Toivonen's method. A sample of the documents, mined length by length at a lowered threshold, proposes phrases. One pass over
    all documents then counts the proposed phrases and their border: every other word, and the other phrases whose two parts of
    one word less are proposed. The border is counted by hash into about as many buckets as there are words; a bucket's count is
    at least that of each of its phrases, so those of a bucket below ``least`` are done with. Any other bucket is a failure of the
    sample, and an expansion pass follows. It counts the phrases of those buckets as they are, and in the same go all that they
    may extend to: phrases whose parts are frequent, in such a bucket, or not counted before. After it nothing is left to expand:
    a frequent phrase has frequent parts only, and each part was proposed, of the border, or let through here. So none is missed,
    and the sample decides only how much is counted.

    The proposed phrases go to the tasks as a filter of a fixed number of bits. What it lets through by chance is counted, too,
    and counts come from the phrases themselves, never from hashes: a full filter costs time, never a result.
    """
    docs = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    drawn = staged(docs.filter(F.rand(7) < sample), "phrase_sample")
    lowered = max(1, int(least * sample * slack))
    bits, width = np.zeros(BITS // 8, np.uint8), 20
    for length in range(1, longest):
        kept = (F.col("words") == 0) | (F.col("n") >= lowered)
        found = staged(_counts(drawn, _of_length, length, bits=bits).filter(kept), "phrases_of_sample")
        bits = _with(bits, found.filter("words > 0"))
        if length == 1:
            seen = found.filter("words = 0").agg(F.sum("n")).first()[0] or 0
            width = min(48, max(width, int(seen / sample).bit_length() if seen else 0))
    enough = (F.col("words") == 0) | (F.col("n") >= least)
    counted = staged(_counts(docs, _with_border, longest, width, bits=bits).filter(F.coalesce(enough, F.col("n") >= least)), "phrases")
    total = counted.filter("bucket is null")
    if counted.filter("bucket is not null").isEmpty():
        return total.drop("bucket")
    found = _with(None, counted.filter(F.col("bucket").isNotNull() | F.col("words").between(1, longest - 1)))
    more = staged(_counts(docs, _beyond, longest, width, bits=bits, found=found).filter(F.col("n") >= least), "phrases_beyond")
    return total.unionByName(more).drop("bucket")


def _absorbed(candidates: DataFrame) -> DataFrame:
    """lang, phrase, covered: the count of the most frequent phrase of one word more that holds a phrase.

    A longer one still that is as frequent has one in between that is so, too.
    """
    inner = F.array(F.expr("substring_index(phrase, ' ', words - 1)"), F.expr("substring_index(phrase, ' ', 1 - words)"))
    return candidates.filter("words > 2").select("lang", F.explode(inner).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("covered"))


def collocations(
    docs: DataFrame,
    least: int = LEAST,
    longest: int = LONGEST,
    first: int = FIRST,
    sample: float = SAMPLE,
    slack: float = SLACK,
    lang: str = "lang",
    text: str = "text",
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``first`` phrases of each language by score.

    A-Z count as a-z; texts are cut into pieces at ``.,;:!?`` and line breaks (0A to 0D), pieces into words at blanks and tabs.
    Phrases are 2 to ``longest`` words in a row within a piece, with a >= ``least`` occurrences, overlaps included, among the n
    words of their language. Cut after its first k words a phrase scores floor(1000 * a * n / (l * r)), l and r the occurrences of
    its parts; the lowest-scoring cut counts, ties to the smallest k. A phrase inside a longer one that is as frequent is left
    out. Order: score and a descending, phrase ascending by its UTF-8 bytes. ``rank`` and all numbers are longs.

    Null texts are empty, a null language is ``und``, an empty table gives an empty result; repeated rows count each time. Texts are
    read whole; a task works on about 1.5 MB of text, or one piece. ``sample`` and ``slack`` change the time only. Other columns are left out.
    """
    named = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    found = frequent_phrases(named, least, longest, sample, slack)
    totals = found.filter("words = 0").groupBy("lang").agg(F.sum("n").alias("total"))
    counts = found.filter("words > 0").select("lang", "phrase", F.col("n").alias("f"))
    candidates = found.filter("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"))
    covered = candidates.join(_absorbed(candidates), ["lang", "phrase"], "left")
    alone = covered.filter("covered is null or 100 * covered < 100 * a").drop("covered")

    cuts = alone.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.withColumn("head", F.expr("substring_index(phrase, ' ', k)")).withColumn("tail", F.expr("substring_index(phrase, ' ', k - words)"))
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")), ["lang", "head"])
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r")), ["lang", "tail"])
    cuts = cuts.join(totals.withColumnRenamed("total", "n"), "lang")
    wide = "cast({} as decimal(17,0))"  # products have up to 38 digits
    score = F.expr(f"(cast(1000 as decimal(4,0)) * {wide.format('a')} * {wide.format('n')}) div ({wide.format('l')} * {wide.format('r')})")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    scored = cuts.groupBy("lang", "phrase", "a", "n").agg(lowest).select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")

    order = [F.desc("score"), F.desc("a"), "phrase"]
    dealt = scored.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(parts(docs.sparkSession))))
    near = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= first)
    ranked = near.drop("part").withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.filter(F.col("rank") <= first).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
