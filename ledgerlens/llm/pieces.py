"""SentencePiece encoding and decoding: words of one length advance together through a numpy Viterbi search."""

from __future__ import annotations

import functools
import itertools
import re
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lists, numbers
from .lookup import Lexicon, Pool, sliced, spans

MARK = "▁"  # stands for a space
PENALTY = 10.0  # an unknown character scores this much below the lowest piece
STEP = 1 << 20  # ids decoded at once
CELLS = 1 << 21  # (word, start, length) cells worked on at once
_HASH = np.uint64(0x100000001B3)
_RUNS = re.compile(f"\n[^{MARK}\n]*|{MARK}+[^{MARK}\n]*")


def piece_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _mixed(chars: np.ndarray) -> np.ndarray:
    x = chars.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    return x * np.uint64(0x94D049BB133111EB)


def _rolled(chars: np.ndarray) -> np.ndarray:
    """Polynomial hashes of all prefixes of the rows."""
    out = np.zeros((chars.shape[0], chars.shape[1] + 1), np.uint64)
    mixed = _mixed(chars)
    for j in range(chars.shape[1]):
        out[:, j + 1] = out[:, j] * _HASH + mixed[:, j]
    return out


class Pieces:
    """Pieces of a model with their scores, as sorted hash keys of their characters."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.texts = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        self.unknown = model.unk_id()
        self.bytes = np.full(256, self.unknown, np.uint32)
        plain, scores = [], []
        for i, text in enumerate(self.texts):
            if model.is_byte(i):
                self.bytes[int(text[3:-1], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                plain.append(i)
                scores.append(model.get_score(i))
        if any(MARK in self.texts[i].lstrip(MARK) or "\n" in self.texts[i] and len(self.texts[i]) > 1 for i in plain):
            raise ValueError("pieces that go over a space or a line break aren't supported")
        self.fallback = bool((self.bytes != self.unknown).all())
        self.longest = max(len(self.texts[i]) for i in plain)
        chars = np.zeros((len(plain), self.longest), np.uint32)
        keys = np.zeros(len(plain), np.uint64)
        for row, i in enumerate(plain):
            own = np.frombuffer(self.texts[i].encode("utf-32-le"), np.uint32)
            chars[row, : len(own)] = own
            keys[row] = _rolled(own[None])[0, -1]
        order = np.argsort(keys)
        self.keys, self.chars = keys[order], chars[order]
        self.ids = np.array(plain, np.uint32)[order]
        self.scores = np.array(scores, np.float64)[order]
        self.power = np.multiply.accumulate(np.concatenate([[1], np.full(self.longest, _HASH)]).astype(np.uint64))
        self.held = np.zeros(1 << 20, bool)  # by the keys' first bits, so that few keys need the search
        self.held[self.keys >> np.uint64(44)] = True
        self.lowest = float(self.scores.min()) - PENALTY

    def matches(self, chars: np.ndarray) -> np.ndarray:
        """Row of the piece that begins at each place and has each length, else -1: (word, start, length - 1)."""
        words, n = chars.shape
        rolled, most = _rolled(chars), min(self.longest, n)
        out = np.full((words, n, most), -1, np.int32)
        for size in range(1, most + 1):
            key = rolled[:, size:] - rolled[:, : n + 1 - size] * self.power[size]
            w, start = np.nonzero(self.held[key >> np.uint64(44)])
            key = key[w, start]
            row = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            w, start, row = (x[self.keys[row] == key] for x in (w, start, row))
            same = (self.chars[row, :size] == chars[w[:, None], start[:, None] + np.arange(size)]).all(axis=1)
            if size < self.longest:
                same &= self.chars[row, size] == 0
            out[w[same], start[same], size - 1] = row[same]
        return out

    def _viterbi(self, found: np.ndarray) -> np.ndarray:
        """Whether a piece begins at each place, on the path with the largest sum of scores; ties go to the longer last piece."""
        words, n, most = found.shape
        scores = np.where(found >= 0, self.scores[found], -np.inf)
        scores[:, :, 0] = np.where(found[:, :, 0] >= 0, scores[:, :, 0], self.lowest)
        best = np.full((words, n + 1), -np.inf)
        best[:, 0] = 0
        back = np.zeros((words, n + 1), np.int32)
        for end in range(1, n + 1):
            sizes = np.arange(min(most, end), 0, -1)  # longest first: the first maximum is the longest piece
            sums = best[:, end - sizes] + scores[:, end - sizes, sizes - 1]
            pick = sums.argmax(axis=1)
            best[:, end] = sums[np.arange(words), pick]
            back[:, end] = sizes[pick]
        begins = np.zeros((words, n), bool)
        at, rows = np.full(words, n), np.arange(words)
        while len(rows):
            at = at - back[rows, at]
            begins[rows, at] = True
            rows, at = rows[at > 0], at[at > 0]
        return begins

    def _merges(self, found: np.ndarray) -> np.ndarray:
        """The same for models whose scores rank merges: the best-scored adjacent pair is joined, the leftmost of equals."""
        words, n, most = found.shape
        begins = np.ones((words, n + 1), bool)
        places = np.arange(n + 1)
        rows = np.arange(words)
        while len(rows) and n > 1:
            own = begins[rows]
            after = np.minimum.accumulate(np.where(own, places, n)[:, ::-1], axis=1)[:, ::-1]
            follow = np.concatenate([after[:, 1:], np.full((len(rows), 1), n)], axis=1)  # the next start behind a place
            end = np.take_along_axis(follow, follow, axis=1)
            size = end - places
            can = own & (follow < n) & (size <= most)
            can[:, n] = False
            piece = found[rows[:, None], np.minimum(places, n - 1), np.where(can, size - 1, 0)]
            score = np.where(can & (piece >= 0), self.scores[piece], -np.inf)
            pick = score.argmax(axis=1)
            on = score[np.arange(len(rows)), pick] > -np.inf
            rows, cut = rows[on], follow[np.arange(len(follow)), pick][on]
            begins[rows, cut] = False
        return begins[:, :n]

    def encode(self, words: list[str], rules: tuple[str, ...]):
        """The words (strings with spaces as marks) by length; for each rule all their ids and the number of ids of each."""
        out: list[list] = [[] for _ in rules]
        order = sorted(words, key=len)
        for n, group in itertools.groupby(order, key=len):
            same = list(group)
            step = max(1, CELLS // (n * min(n, self.longest)))
            for a in range(0, len(same), step):
                part = same[a : a + step]
                chars = np.frombuffer("".join(part).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(part), n)
                found = self.matches(chars)
                for column, rule in zip(out, rules):
                    column.append(self._cut(chars, found, RULES[rule](self, found)))
        return order, [(np.concatenate([x for x, _ in c]), np.concatenate([x for _, x in c])) for c in out]

    def _cut(self, chars: np.ndarray, found: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w, start = np.nonzero(begins)
        last = np.append(w[1:] != w[:-1], True)
        size = np.where(last, chars.shape[1], np.append(start[1:], 0)) - start
        row = found[w, start, size - 1]
        ids, many = self.ids[row], np.ones(len(row), np.int64)
        lost = np.flatnonzero(row < 0)
        if len(lost):  # characters without a piece
            instead = [self._unknown(chr(c)) for c in chars[w[lost], start[lost]]]
            many[lost] = [len(x) for x in instead]
            ids = np.repeat(ids, many)
            at = np.cumsum(many) - many
            for i, x in zip(lost, instead):
                ids[at[i] : at[i] + len(x)] = x
        return ids, np.bincount(w, many, len(chars)).astype(np.int64)

    def _unknown(self, char: str) -> np.ndarray:
        if not self.fallback:
            return np.array([self.unknown], np.uint32)
        return self.bytes[np.frombuffer(char.encode("utf-8", "replace"), np.uint8)]

    def spelled(self) -> Pool:
        """The bytes that each id stands for."""
        pool = Pool(np.uint8)
        of_byte = {int(i): b for b, i in enumerate(self.bytes) if i != self.unknown}
        plain = set(self.ids.tolist())
        texts = [bytes([of_byte[i]]) if i in of_byte else t.replace(MARK, " ").encode() if i in plain else " ⁇ ".encode() if i == self.unknown else b"" for i, t in enumerate(self.texts)]
        pool.add(np.frombuffer(b"".join(texts), np.uint8), np.array([len(t) for t in texts], np.int64))
        return pool


@functools.lru_cache(2)
def spelled(path: str) -> Pool:
    """Kept by a worker from task to task."""
    return Pieces(path).spelled()


RULES = {"viterbi": Pieces._viterbi, "merges": Pieces._merges}


def _split(texts: pa.Array) -> pa.Array:
    """Words of each text (none null): a word begins at a run of spaces or at a line break, and no piece goes over such a place.

    A word's first mark is left out, so plain text needs no more than a split; texts with runs of spaces go through a pattern.
    """
    lines = pc.replace_substring(texts, "\n", " \n")
    odd = pc.or_(pc.match_substring(lines, "  "), pc.match_substring(texts, MARK))
    odd = pc.or_(odd, pc.or_(pc.starts_with(lines, " "), pc.or_(pc.ends_with(lines, " "), pc.equal(texts, ""))))
    odd = odd.to_numpy(zero_copy_only=False)
    split = pc.split_pattern(lines.filter(pa.array(~odd)), " ")
    if not odd.any():
        return split
    runs = [_RUNS.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts.filter(pa.array(odd)).to_pylist()]
    apart = pa.array([[w[1:] if w[0] == MARK else w for w in r] for r in runs], split.type)
    order = np.argsort(np.concatenate([np.flatnonzero(~odd), np.flatnonzero(odd)]))
    return pa.concat_arrays([split, apart]).take(pa.array(order))


@functools.lru_cache(4)
def lexicon(path: str, rules: tuple[str, ...]) -> Lexicon:
    """Kept by a worker from task to task."""
    pieces = Pieces(path)

    def learn(new: list[str]):
        order, columns = pieces.encode([w if w[:1] == "\n" else MARK + w for w in new], rules)
        return [w[1:] if w[0] == MARK else w for w in order], columns

    return Lexicon(learn, len(rules))


def _lists(flat: np.ndarray, ends: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32, copy=False)))


def _encoded(path: Callable[[], str], rules: tuple[str, ...]):
    def run(batches):
        known = lexicon(path(), rules)
        for batch in sliced(batches, "text"):
            split = _split(pa.concat_arrays([pc.fill_null(batch.column("text"), "")]))  # its own buffers, from 0 on
            runs = split.flatten().dictionary_encode()
            codes, _ = known.codes([runs.dictionary.to_pylist()])
            codes, counts = codes[numbers(runs.indices)], numbers(split.value_lengths())
            columns = [_lists(*pool.joined(codes, counts)) for pool in known.pools]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text"), *columns], ["doc_id", "text", *rules])

    return run


def encode(docs: DataFrame, rules: tuple[str, ...] = ("viterbi",), path: Callable[[], str] = piece_bpe, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text and a list of ids for each rule.

    "viterbi" takes the segmentation with the largest sum of piece scores, as unigram models are meant; "merges" joins pairs by
    score, as models of merges are meant (their own library encodes so). A space before the text and for every space the mark
    are put in; characters without a piece become their bytes' pieces. Null and empty texts have no ids; rows that repeat and
    null doc_ids are kept as they are; an empty table gives an empty result; other columns are left out. Words are worked out
    once and looked up then, long texts run by run.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    kinds = "doc_id long, text string, " + ", ".join(f"{r} array<int>" for r in rules)
    return rows.mapInArrow(_encoded(path, rules), kinds)


def _short(batches, column: str):
    for batch in batches:
        for part in spans(numbers(batch.column(column).value_lengths()).tolist(), STEP):
            yield batch.slice(part.start, part.stop - part.start)


def _decoded(path: Callable[[], str], columns: tuple[str, ...], kept: tuple[str, ...]):
    def run(batches):
        pool = spelled(path())
        for batch in _short(batches, columns[0]):
            out = []
            for column in columns:
                ids = batch.column(column)
                flat, ends = pool.joined(numbers(ids.flatten()), numbers(ids.value_lengths()))
                text, begin = flat.tobytes(), np.concatenate([[0], ends[:-1]]).tolist()
                found = (text[a + (text[a : a + 1] == b" ") : b] if b > a else b"" for a, b in zip(begin, ends.tolist()))
                out.append(pa.array([t.decode("utf-8", "replace") for t in found], pa.string()))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in kept), *out], [*kept, *(f"{c}_text" for c in columns)])

    return run


def decode(rows: DataFrame, columns: tuple[str, ...], path: Callable[[], str] = piece_bpe) -> DataFrame:
    """The rows with a text column ``<column>_text`` for each list of ids (no null lists): pieces joined, marks as spaces, the
    leading one dropped, byte pieces as bytes. Control pieces have no text."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    kinds += "".join(f", `{c}_text` string" for c in columns)
    return rows.mapInArrow(_decoded(path, columns, tuple(rows.columns)), kinds)


def _digested(batches):
    """Round trips reduced to counts and checksums."""
    for batch in batches:
        texts = pc.replace_substring(pc.fill_null(batch.column("text"), ""), MARK, " ")
        columns, names = [batch.column("doc_id")], ["doc_id"]
        for rule, name in (("merges", "ids"), ("viterbi", "viterbi")):
            ids = lists(batch.column(rule), np.uint32)
            same = pc.equal(texts, batch.column(f"{rule}_text"))
            columns += [pa.array([len(x) for x in ids], pa.int64()), pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64()), same]
            names += [f"n_{name}", f"{name}_crc32", f"{name}_round_trip"]
        yield pa.RecordBatch.from_arrays(columns, names)


def round_trips(docs: DataFrame, path: Callable[[], str] = piece_bpe, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every text encoded by both rules and decoded again: per row counts, crc32 of the ids (little-endian unsigned 32-bit) and
    whether the text came back (a mark in the text comes back as a space). ``ids`` are by merges, as the given model is one of
    merges and its scores rank these; ``viterbi`` are the segmentation with the largest sum of scores. All three steps are one
    pass over the rows, a part of a batch at a time."""
    rules = ("viterbi", "merges")
    kinds = "doc_id long, n_ids long, ids_crc32 long, ids_round_trip boolean, n_viterbi long, viterbi_crc32 long, viterbi_round_trip boolean"
    encoded, decoded = _encoded(path, rules), _decoded(path, rules, ("doc_id", "text", *rules))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(lambda batches: _digested(decoded(encoded(batches))), kinds)
