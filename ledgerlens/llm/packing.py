"""Best-fit packing of tokenised documents under several capacities at once."""

from __future__ import annotations

import itertools
import os
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.session import staged
from .common import numbers, parts
from .lookup import STEP, Kept, Lexicon, Pool, sliced

TOKENS = 2048  # capacity of a sequence
STEMS = 400_000  # stems that a worker remembers (about 100 MB); it starts anew beyond that
END = 0  # the id after each document


def word_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


_BETWEEN = "<|endoftext|>"  # a special token, so that many words can be encoded at once
_LETTERS = "^[a-zß-öø-ÿ]+$"
_SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"  # without the apostrophe, which may begin an ending such as 's
_CLOSED = "[a-z0-9ß-öø-ÿ]$"  # what signs at the end are encoded apart from


class Stems:
    """Ids of runs of characters, by the tokenizer."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.between = self.whole.token_to_id(_BETWEEN)
        # small letters are left as they are by the normalizer and are one word for the pre-tokenizer: only the merges are needed
        self.letters = Tokenizer.from_file(path)
        self.letters.normalizer = normalizers.Sequence([])
        self.letters.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)

    def encode(self, stems: list[str]):
        """Ids of stems, many to a call; those with the sign of special tokens one by one."""
        held = pa.array(stems, pa.string())
        simple = pc.match_substring_regex(held, _LETTERS).to_numpy(zero_copy_only=False)
        odd = pc.match_substring(held, "<|").to_numpy(zero_copy_only=False)
        letters, plain, special = (list(itertools.compress(stems, mask)) for mask in (simple, ~simple & ~odd, odd))
        ids, lengths = [], []
        for tokenizer, some, step in ((self.letters, letters, 64), (self.whole, plain, 128), (self.whole, special, 1)):
            for a in range(0, len(some), step):
                part = some[a : a + step]
                joined = part[0] if step == 1 else _BETWEEN.join(part)
                # the fast call leaves out places in the text; the ids are the same
                found = np.array(tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, dtype=np.uint32)
                ends = np.flatnonzero(found == self.between) if step > 1 else np.zeros(0, np.int64)
                lengths.append(np.diff(ends, prepend=-1, append=len(found)) - 1)
                ids.append(np.delete(found, ends))
        return letters + plain + special, [(np.concatenate(ids), np.concatenate(lengths))]


class Words:
    """Ids of texts, by runs of characters between ASCII white space.

    The tokenizer drops white space and never joins over it, so a text's ids are those of its runs, one after the other. It lowers
    letters, and the signs that end a run behind a letter or digit are encoded by themselves, so runs that differ in these
    share what has to be encoded.
    """

    def __init__(self, path: str):
        self.stems = Lexicon(Stems(path).encode, most=STEMS)  # nothing refers back, so all of it goes with its last use

    def ids(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text (none null)."""
        special = pc.match_substring(texts, "<|")  # special tokens are told by case
        lowered = pc.if_else(special, texts, pc.ascii_lower(texts))
        split = pc.ascii_split_whitespace(lowered)
        runs = split.flatten().dictionary_encode()
        words, here = runs.dictionary, Pool()
        here.add(*self._distinct(words))
        return here.gather(numbers(runs.indices), numbers(split.value_lengths()))

    def _distinct(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct runs one after the other, and their number for each run."""
        trimmed = pc.ascii_rtrim(words, characters=_SIGNS)
        size, left = (numbers(pc.binary_length(x)) for x in (words, trimmed))
        some = np.flatnonzero((size != left) & ~pc.match_substring(words, "<|").to_numpy(zero_copy_only=False))
        some = some[pc.match_substring_regex(trimmed.take(pa.array(some)), _CLOSED).to_numpy(zero_copy_only=False)]
        closed = np.zeros(len(words), bool)
        closed[some] = True
        stems = pc.if_else(pa.array(closed), trimmed, words).dictionary_encode()
        tails = _ends(words, left[some], some).dictionary_encode()
        found, _ = self.stems.codes([[*stems.dictionary.to_pylist(), *tails.dictionary.to_pylist()]])
        apart = len(stems.dictionary)
        at = np.cumsum(1 + closed) - 1 - closed
        codes = np.empty(len(words) + int(closed.sum()), np.int64)
        codes[at] = found[numbers(stems.indices)]
        codes[at[closed] + 1] = found[apart:][numbers(tails.indices)]
        flat, ends = self.stems.pools[0].joined(codes, 1 + closed)
        return flat, np.diff(ends, prepend=0)


def _ends(texts: pa.Array, begin: np.ndarray, rows: np.ndarray) -> pa.Array:
    """What some rows of a string array hold from a byte on."""
    at = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    size = at[rows + 1] - at[rows] - begin
    ends = np.concatenate([[0], np.cumsum(size)])
    places = np.repeat(at[rows] + begin - ends[:-1], size) + np.arange(ends[-1])
    held = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[places]
    return pa.StringArray.from_buffers(len(rows), pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(held))


def _pieces(path: Callable[[], str], tokens: int, shared=None):
    """doc_id, text -> doc_id, piece, start, length, ids_crc32, deal; a broadcast of ``Kept`` keeps the words from task to task."""

    def run(batches):
        known, deal = (shared.value if shared else Kept()).get(lambda: Words(path())), 0
        for batch in sliced(batches, "text"):
            texts = pa.concat_arrays([pc.fill_null(batch.column("text"), "")])  # its own buffers, from 0 on
            out: list[list[int]] = [[], [], [], [], []]
            for at, ids in enumerate(known.ids(texts)):
                ids = np.append(ids, np.uint32(END))
                for piece, start in enumerate(range(0, len(ids), tokens)):
                    cut = ids[start : start + tokens]
                    for column, value in zip(out, (at, piece, start, len(cut), zlib.crc32(cut.astype("<u4").tobytes()))):
                        column.append(value)
            n = len(out[0])
            ids = batch.column("doc_id").take(pa.array(out[0], pa.int64()))
            dealt = np.arange(deal, deal + n, dtype=np.int64)
            deal += n
            yield pa.RecordBatch.from_arrays(
                [ids, *(pa.array(x, pa.int64()) for x in out[1:]), pa.array(dealt)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "deal"],
            )

    return run


class Plan:
    """Which ranks of each length go to which sequences: runs (length, first rank, count, first sequence, offset).

    Vector best fit over counts of equal lengths, longest first. A sequence has residual capacities of tokens, documents and
    attention cost (the sum of squared lengths); a document goes to a sequence with room in all of them, that which leaves the
    least weighted residual norm, or which has the largest weighted dot product of residual and demand. Sequences of equal
    content are one entry, so the work depends on the number of lengths, not of documents.
    """

    def __init__(self, counts: dict[int, int], tokens: int, documents: int, cost: int, weights=(1.0, 1.0, 1.0), rule: str = "norm"):
        capacity = np.array([tokens, documents, cost], dtype=np.int64)
        weight = np.asarray(weights, dtype=float) / capacity
        self.runs: list[tuple[int, int, int, int, int]] = []
        self.sequences = 0
        left = np.zeros((0, 3), np.int64)
        first, many = np.zeros(0, np.int64), np.zeros(0, np.int64)
        least = min(counts, default=0)
        for length in sorted(counts, reverse=True):
            need = np.array([length, 1, length * length], dtype=np.int64)
            if (need > capacity).any():
                raise ValueError(f"a piece of {length} tokens exceeds the capacity of an empty sequence")
            rank, rest = 0, counts[length]
            while rest:
                fits = np.flatnonzero((left >= need).all(axis=1))
                if len(fits):
                    if rule == "norm":
                        best = fits[np.argmin((np.square((left[fits] - need) * weight)).sum(axis=1))]
                    else:
                        best = fits[np.argmax((left[fits] * weight * need * weight).sum(axis=1))]
                    n = min(rest, int(many[best]))
                    self.runs.append((length, rank, n, int(first[best]), int(tokens - left[best, 0])))
                    after = left[best] - need
                    if n == many[best]:
                        left[best] = after
                    else:
                        left = np.concatenate([left, after[None]])
                        first, many = np.append(first, first[best]), np.append(many, n)
                        first[best] += n
                        many[best] -= n
                else:
                    repeat = int((capacity // need).min())
                    n, times = (rest // repeat, repeat) if rest >= repeat else (1, rest)
                    for i in range(times):
                        self.runs.append((length, rank + i * n, n, self.sequences, i * length))
                    left = np.concatenate([left, (capacity - times * need)[None]])
                    first, many = np.append(first, self.sequences), np.append(many, n)
                    self.sequences += n
                    n *= times
                rank, rest = rank + n, rest - n
            keep = (left[:, 0] >= least) & (left[:, 1] > 0) & (left[:, 2] >= least * least)
            left, first, many = left[keep], first[keep], many[keep]

    def place(self):
        """A function for mapInArrow: rows with length and rank get sequence_id and offset."""
        runs = np.array(self.runs, dtype=np.int64).reshape(-1, 5)
        runs = runs[np.lexsort((runs[:, 1], runs[:, 0]))]
        # lengths and ranks as one sorted key: ranks are below 2^48
        keys = (runs[:, 0] << 48) + runs[:, 1]

        def run(batches):
            for batch in batches:
                length, rank = numbers(batch.column("length")), numbers(batch.column("rank"))
                at = np.searchsorted(keys, (length << 48) + rank, side="right") - 1
                columns = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(runs[at, 3] + rank - runs[at, 1]), pa.array(runs[at, 4])],
                    ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
                )

        return run


def packed(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    path: Callable[[], str] = word_bpe,
    tokens: int = TOKENS,
    documents: int = TOKENS,
    cost: int = TOKENS * TOKENS,
    rule: str = "norm",
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its ids and an id 0; longer ones than ``tokens`` are cut into pieces of that many. The plan is made from the
    number of pieces of each length (at most ``tokens`` numbers reach the driver); every piece then finds its place by its rank
    among the pieces of its length. Ranks are counted in parts of a length, so a length may hold any share of the rows.

    Null text counts as empty (one piece of the id 0); rows that repeat, and null doc_ids, are documents of their own; an empty
    table gives an empty result; other columns are left out. Texts of any length are worked on run by run.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    kinds = "doc_id long, piece long, start long, length long, ids_crc32 long, deal long"
    kept = docs.sparkSession.sparkContext.broadcast(Kept())
    pieces = staged(rows.mapInArrow(_pieces(path, tokens, kept), kinds), "pieces", batch=STEP)
    strips = parts(docs.sparkSession)
    pieces = pieces.withColumn("strip", F.pmod("deal", F.lit(strips)))
    counts = staged(pieces.groupBy("length", "strip").agg(F.count(F.lit(1)).alias("n")), "piece_counts")
    total = counts.groupBy("length").agg(F.sum("n").alias("n")).collect()  # at most ``tokens`` rows
    plan = Plan({r["length"]: r["n"] for r in total}, tokens, documents, cost, rule=rule)
    before = Window.partitionBy("length").orderBy("strip").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("length", "strip", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("length", "strip").orderBy("doc_id", "piece", "deal", "ids_crc32")
    ranked = (
        pieces.withColumn("place", F.row_number().over(within) - 1)
        .join(base.hint("merge"), ["length", "strip"])
        .withColumn("rank", F.col("base") + F.col("place"))
    )
    kinds = "doc_id long, piece long, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(plan.place(), kinds)
