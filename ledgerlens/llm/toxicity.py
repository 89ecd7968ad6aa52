"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over all their words, those that go with the label weighing more."""

from __future__ import annotations

import hashlib
import itertools
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from ..sources.session import staged
from .common import listed, lists, numbers
from .lookup import STEP, released, sliced

EXAMPLES = 20_000  # labelled rows that the index is fitted on, at most; those with the smallest hash
PURE = 0.8  # share of toxic rows among those that hold a term, at least
EVIDENCE = 14.0  # a term's log-likelihood gain over the prior, at least: by chance less than one of a million terms has it
NEIGHBOURS = 15
BLOCK = 64  # examples of a block of the index
HEAD = 512  # terms that most examples of a cluster hold; these open no block
GROUP = 8  # of them share a bound
CLUSTERS, ROUNDS = 8, 6  # of examples that share heavy terms, as the blocks do
FIRST = 4  # blocks that are opened first
ROUNDING = 1e-5  # more than single precision can be off
PART = 500_000  # postings that are sorted at once
QUERIES = 64  # texts that are compared with the examples at once
MARKED = 0.9  # share of the terms that go with the label in the cosine of two texts that both hold such terms
POWER = 4  # of the cosine, as a vote
CALM = 0.4  # weight of the prior among the votes
STRETCH = 1000  # words; in a longer text a term must occur as often in every such stretch, on average
PREFIXES = (4, 5, 6, 7)
TIMES = (1, 2, 4)  # a term counts anew as one that occurs so often

_WORD = re.compile(r"[^\W\d_]+")


def _terms(word: str) -> list[str]:
    """The word itself and its first letters, which inflected forms share."""
    return [word, *(f"{word[:n]}-" for n in PREFIXES if len(word) >= n)]


def _hashes(words) -> np.ndarray:
    """64-bit hashes that stand for the words: two of a million words share one with a probability below 1e-7."""
    return np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words))


def _counted(batches):
    """text, toxic -> term, times, rows with it, toxic rows with it (part sums)."""
    for batch in sliced(batches, "text", 1 << 20):
        sums = {(k, bad): Counter() for k in TIMES for bad in (False, True)}
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            own = Counter(_WORD.findall((text or "").lower()))
            tf: dict[str, int] = dict(own)
            for size in PREFIXES:
                for w, n in own.items():
                    if len(w) >= size:
                        t = w[:size] + "-"
                        tf[t] = tf.get(t, 0) + n
            least = max(1, own.total() / STRETCH)
            found = tf
            for k in TIMES:
                if k > 1:  # these are among those that occur less often
                    enough = k * least
                    found = {t: n for t, n in found.items() if n >= enough}
                sums[k, toxic > 0].update(list(found))
        for k in TIMES:
            bad = sums[k, True]
            both = sums[k, False] + bad
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(both), pa.string()), pa.array([k] * len(both), pa.int32()),
                    pa.array(list(both.values()), pa.int64()), pa.array([bad[t] for t in both], pa.int64()),
                ],
                ["term", "times", "n", "toxic"],
            )


def _named(batches):
    """term -> hash."""
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(_hashes(batch.column("term").to_pylist()).view(np.int64))], ["hash"])


def _vectors(shared):
    """doc_id, row, held_out, text -> doc_id, row, held_out, terms (sorted numbers), counts, other (weight of the words no example has)."""

    def run(batches):
        number, vocabulary = shared.value
        chosen = {t: i for i, t in enumerate(sorted({t for t, _ in number}))}
        begins = {t.rstrip("-")[: PREFIXES[0]] for t in chosen}  # shared by every word with a chosen term
        numbered = np.array([[number.get((t, k), -1) for k in TIMES] for t in chosen], np.int64).reshape(-1, len(TIMES))
        size = len(number) + len(vocabulary)
        for batch in sliced(batches, "text"):
            texts = [_WORD.findall((text or "").lower()) for text in batch.column("text").to_pylist()]
            total = np.fromiter(map(len, texts), np.int64, len(texts))
            coded = pa.array(list(itertools.chain.from_iterable(texts)), pa.string()).dictionary_encode()
            del texts
            words = coded.dictionary.to_pylist()
            hashes = _hashes(words)
            order = np.argsort(hashes)  # near ones are looked up one after the other
            at = np.empty(len(words), np.int64)
            at[order] = np.searchsorted(vocabulary, hashes[order])
            at[at == len(vocabulary)] = 0
            hit = vocabulary[at] == hashes if len(vocabulary) else np.zeros(len(words), bool)
            width = size + len(words)  # words that no example has are told apart by numbers beyond the others
            names = np.where(hit, at + len(number), size + np.arange(len(words)))
            keys, times = _summed(np.repeat(np.arange(len(total)) * width, total) + names[numbers(coded.indices)])
            doc, name = np.divmod(keys, width)
            inside = name < size
            other = np.bincount(doc[~inside], np.square(1 + np.log(times[~inside])), len(total))
            found = [(n, chosen[t]) for n, w in zip(names.tolist(), words) if w[: PREFIXES[0]] in begins for t in _terms(w) if t in chosen]
            marks, sums = _marked(found, width, doc, name, times, len(chosen))
            mark, term = np.divmod(marks, max(1, len(chosen)))
            least = np.maximum(1, total / STRETCH)[mark]
            held = [(np.flatnonzero((numbered[term, i] >= 0) & (sums >= (k * least if k > 1 else 1))), i, k) for i, k in enumerate(TIMES)]
            places = np.concatenate([doc[inside] * size + name[inside], *[mark[x] * size + numbered[term[x], i] for x, i, _ in held]])
            counts = np.concatenate([times[inside], *[sums[x] if k == 1 else np.ones(len(x), np.int64) for x, _, k in held]])
            order = np.argsort(places, kind="stable")
            doc, terms = np.divmod(places[order], max(1, size))
            cut = pa.array(np.searchsorted(doc, np.arange(len(total) + 1)), pa.int32())
            terms, counts = (pa.ListArray.from_arrays(cut, pa.array(x, pa.int32())) for x in (terms, counts[order]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row"), batch.column("held_out"), terms, counts, pa.array(other, pa.float64())],
                ["doc_id", "row", "held_out", "terms", "counts", "other"],
            )

    return run


def _summed(keys: np.ndarray, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order, and how often each occurs or what its ``times`` add up to."""
    if times is not None:
        order = np.argsort(keys, kind="stable")
        keys, times = keys[order], times[order]
    else:
        keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.diff(first, append=len(keys)) if times is None or not len(keys) else np.add.reduceat(times, first)


def _marked(found: list[tuple[int, int]], width: int, doc: np.ndarray, name: np.ndarray, times: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """text * size + term of the chosen terms in each text, and how often they occur, by the terms ``found`` in words (name below ``width``, term)."""
    found = np.array(sorted(found), np.int64).reshape(-1, 2)
    each = np.bincount(found[:, 0], minlength=width)
    at = np.flatnonzero(each[name])
    long = each[name[at]]
    which = np.repeat((np.cumsum(each) - each)[name[at]] - np.cumsum(long) + long, long) + np.arange(long.sum())
    return _summed(np.repeat(doc[at], long) * size + found[which, 1], np.repeat(times[at], long))


def _held(size: int):
    """terms -> term, n: the rows with each term (part sums)."""

    def run(batches):
        sums = np.zeros(size, np.int64)
        for batch in batches:
            sums += np.bincount(numbers(batch.column("terms").flatten()), minlength=size)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(sums[at], pa.int64())], ["term", "n"])

    return run


def _weights(terms: np.ndarray, counts: np.ndarray, other: float, idf: np.ndarray, marks: int, rare: float) -> np.ndarray:
    """Weights of length 1 together with the words that no example has, which are as rare as a word of one document.

    Terms below ``marks`` go with the label: together they have the share ``MARKED`` of the square, all words the rest.
    """
    w = (1 + np.log(counts)) * idf[terms]
    cut = np.searchsorted(terms, marks)
    length = math.sqrt(w[cut:] @ w[cut:] + other * rare * rare)
    if not cut:
        return w / length
    w[:cut] *= math.sqrt(MARKED) / np.linalg.norm(w[:cut])
    w[cut:] *= math.sqrt(1 - MARKED) / length
    return w


def _clusters(unit: np.ndarray, length: np.ndarray) -> np.ndarray:
    """A cluster for each row of length 1 (or 0, as its ``length`` was) by direction: the means settle in a few rounds."""
    some = np.flatnonzero(length)  # seeds lie evenly among the rows
    means = unit[some[np.linspace(0, len(some) - 1, CLUSTERS).astype(np.int64)]] if len(some) else unit[:1]
    for _ in range(ROUNDS):
        near = (unit @ means.T).argmax(axis=1)
        means = (near == np.arange(CLUSTERS)[:, None]).astype(np.float32) @ unit  # sums, without copies of the rows
        means /= np.maximum(np.linalg.norm(means, axis=1, keepdims=True), 1e-9)
    return near


class BlockMaxIndex:
    """Examples in blocks of those that share heavy terms, with inverted lists and bounds that leave most blocks unopened.

    A block has examples of one cluster, whose most common terms (``HEAD``) never open it. All others have inverted lists, which give
    each example its exact sum over them; the common terms can add at most the sum, over groups of ``GROUP`` of them, of the products of the text's and
    the example's lengths within the group. A block's bound is the largest of its examples; the blocks with the highest
    bounds are opened first, and then those alone whose bound reaches the k-th best cosine found there. Cosines of opened blocks are summed in
    single precision; those that can be among the k best are worked out again in double precision from the examples' own terms,
    so the result is exact. ``asked`` counts the examples of all searches, ``opened`` those whose common terms were multiplied.
    """

    def __init__(self, examples: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, ids: np.ndarray, size: int):
        self.labels, self.ids, self.size, self.rows = labels, ids, size, len(examples)
        lengths = np.array([len(t) for t, _ in examples], np.int64)
        self.cut = np.concatenate([[0], np.cumsum(lengths)])
        self.terms = np.concatenate([t for t, _ in examples]).astype(np.int32, copy=False) if examples else np.zeros(0, np.int32)
        self.values = np.concatenate([w for _, w in examples]) if examples else np.zeros(0)
        self.lists = None
        self.asked = self.opened = 0

    def __getstate__(self):
        """Terms and weights of the examples alone; workers put blocks and lists together by themselves."""
        return {k: self.__dict__[k] for k in ("labels", "ids", "size", "rows", "cut", "terms", "values")} | {"lists": None, "asked": 0, "opened": 0}

    def _open(self) -> None:
        often = np.bincount(self.terms, minlength=self.size)
        top = np.argsort(-often, kind="stable")[: min(HEAD, self.size)]
        place = np.full(self.size, -1, np.int32)
        place[top] = np.arange(len(top))
        space = np.zeros(((-(-self.rows // BLOCK) + CLUSTERS) * BLOCK, len(top)), np.float32)  # for the faces, then for the blocks
        faces = space[: self.rows]
        parts = [slice(a, a + PART) for a in range(0, len(self.terms), PART)]  # so that little is held beside the lists
        for part in parts:
            at = place[self.terms[part]]
            common = np.flatnonzero(at >= 0)
            faces[self._row(part.start + common), at[common]] = self.values[part.start + common]
        lengths = np.sqrt(np.einsum("ij,ij->i", faces, faces))
        faces /= np.maximum(lengths, 1e-9)[:, None]
        near = _clusters(faces, lengths)
        del faces
        space[:] = 0
        sizes = np.bincount(near, minlength=CLUSTERS)
        filled = -(-sizes // BLOCK)
        self.blocks, self.of = int(filled.sum()), np.repeat(np.arange(CLUSTERS), filled)  # a block has examples of one cluster
        self.span = np.concatenate([[0], np.cumsum(filled)])
        rows = np.lexsort((-lengths, near))
        at = np.empty(self.rows, np.int32)  # the place of each example in the blocks
        at[rows] = np.arange(self.rows) + np.repeat(self.span[:-1] * BLOCK - np.cumsum(sizes) + sizes, sizes)
        self.order = np.full(self.blocks * BLOCK, -1)
        self.order[at] = np.arange(self.rows)
        held = np.zeros((CLUSTERS, self.size), np.int32)
        for part in parts:
            np.add.at(held, (near[self._row(np.arange(part.start, min(part.stop, len(self.terms))))], self.terms[part]), 1)
        self.place = np.full((self.size, CLUSTERS), -1, np.int16)
        for c in range(CLUSTERS):
            top = np.argpartition(-held[c], len(top) - 1)[: len(top)]
            top = top[np.lexsort((top, -held[c, top]))]
            self.place[top, c] = np.where(held[c, top] > 0, np.arange(len(top)), -1)
        del held
        self.head = space[: self.blocks * BLOCK]
        rare = np.empty(len(self.terms), bool)
        for part in parts:
            row = self._row(np.arange(part.start, min(part.stop, len(self.terms))))
            column = self.place[self.terms[part], near[row]]
            common = np.flatnonzero(column >= 0)
            self.head[at[row[common]], column[common]] = self.values[part][common]
            rare[part] = column < 0
        groups = np.arange(0, len(top), GROUP)
        self.lengths = np.empty((len(groups), len(self.head)), np.float32)
        for a in range(0, len(self.head), BLOCK):
            self.lengths[:, a : a + BLOCK] = np.sqrt(np.add.reduceat(np.square(self.head[a : a + BLOCK]), groups, axis=1)).T
        self.head = self.head.reshape(self.blocks, BLOCK, len(top))
        self.begin = np.concatenate([[0], np.cumsum(np.bincount(self.terms[rare], minlength=self.size))])
        self.lists = np.empty(self.begin[-1], [("place", np.int32), ("value", np.float32)])
        low = 0
        while low < self.size:
            high = max(low + 1, int(np.searchsorted(self.begin, self.begin[low] + PART, side="right")) - 1)
            rest = np.flatnonzero((self.terms >= low) & (self.terms < high) & rare)
            rest = rest[np.argsort(self.terms[rest], kind="stable")]
            span = slice(self.begin[low], self.begin[high])
            self.lists["place"][span], self.lists["value"][span] = at[self._row(rest)], self.values[rest]
            low = high
        self.dense, self.asks, self.count = np.zeros(self.size), np.zeros(self.size, bool), np.arange(PART)
        released()

    def _row(self, at: np.ndarray) -> np.ndarray:
        """The examples that postings belong to."""
        return np.searchsorted(self.cut, at, side="right") - 1

    def nearest(self, texts: list[tuple[np.ndarray, np.ndarray]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each text (terms, weights) the rows and cosines of the k nearest examples that share a term, nearest first, ties to the earlier row."""
        if not self.rows:
            return [(np.zeros(0, np.int64), np.zeros(0)) for _ in texts]
        if self.lists is None:
            self._open()
        common = np.zeros((CLUSTERS, len(texts), self.head.shape[2]), np.float32)
        sums = np.zeros((len(texts), self.blocks * BLOCK), np.float32)
        for i, (terms, weights) in enumerate(texts):
            column = self.place[terms]
            which, cluster = np.nonzero(column >= 0)
            common[cluster, i, column[which, cluster]] = weights[which]
            begin = self.begin[terms]
            long = self.begin[terms + 1] - begin
            total = int(long.sum())
            if total:
                at = np.repeat(begin - np.cumsum(long) + long, long)
                at += self.count[:total] if total <= len(self.count) else np.arange(total)
                found = self.lists.view(np.int64)[at].view(self.lists.dtype)
                sums[i] = np.bincount(found["place"], found["value"] * np.repeat(weights.astype(np.float32), long), sums.shape[1])
        lengths = np.sqrt(np.add.reduceat(np.square(common), np.arange(0, common.shape[2], GROUP), axis=2))
        bounds = np.empty_like(sums)
        for c in range(CLUSTERS):
            span = slice(self.span[c] * BLOCK, self.span[c + 1] * BLOCK)
            np.matmul(lengths[c], self.lengths[:, span], out=bounds[:, span])
        bounds += sums
        bounds = bounds.reshape(len(texts), self.blocks, BLOCK).max(axis=2)
        sums = sums.reshape(len(texts), self.blocks, BLOCK)
        first = min(FIRST, self.blocks)
        highest = np.argpartition(-bounds, first - 1, axis=1)[:, :first]
        enough = np.zeros(len(texts), np.float32)
        for i, blocks in enumerate(highest):
            scores = np.concatenate([sums[i, b] + self.head[b] @ common[self.of[b], i] for b in blocks.tolist()])
            if len(scores) > k:
                enough[i] = np.partition(scores, len(scores) - k)[len(scores) - k]
        wanted = (bounds >= enough[:, None] - ROUNDING) & (bounds > 0)
        for b in np.flatnonzero(wanted.any(axis=0)):
            asking = np.flatnonzero(wanted[:, b])
            sums[asking, b] += common[self.of[b], asking] @ self.head[b].T
        self.asked += len(texts) * self.rows
        self.opened += int(wanted.sum()) * BLOCK
        return [self._best(terms, weights, sums[i], np.flatnonzero(wanted[i]), float(enough[i]), k) for i, (terms, weights) in enumerate(texts)]

    def _best(self, terms: np.ndarray, weights: np.ndarray, sums: np.ndarray, blocks: np.ndarray, enough: float, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best of the opened blocks, worked out from the examples' own terms."""
        scores = sums[blocks].ravel()
        keep = np.flatnonzero(scores >= enough - ROUNDING if enough > ROUNDING else scores > 0)
        if len(keep) > k:
            found = scores[keep]
            keep = keep[found >= np.partition(found, len(found) - k)[len(found) - k] - ROUNDING]
        if not len(keep):
            return np.zeros(0, np.int64), np.zeros(0)
        rows = self.order[blocks[keep // BLOCK] * BLOCK + keep % BLOCK]
        spans = [slice(a, b) for a, b in zip(self.cut[rows].tolist(), self.cut[rows + 1].tolist())]
        begin = np.cumsum([0] + [x.stop - x.start for x in spans[:-1]])
        own = np.concatenate([self.terms[x] for x in spans])
        self.dense[terms] = weights
        self.asks[terms] = True
        shared = np.flatnonzero(self.asks[own])
        row = np.searchsorted(begin, shared, side="right") - 1
        found = np.bincount(row, self.dense[own[shared]] * self.values[shared + (self.cut[rows] - begin)[row]], len(rows))
        self.dense[terms] = 0
        self.asks[terms] = False
        best = np.lexsort((rows, -found))[:k]
        return rows[best], found[best]

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """``nearest`` of one text."""
        return self.nearest([(terms, weights)], k)[0]


def _scored(shared, idf_marks: tuple):
    """doc_id, row, held_out, terms, counts, other -> doc_id, row, held_out, score, predicted, evidence."""
    evidence = pa.list_(pa.struct([("doc_id", pa.int64()), ("toxic", pa.int32()), ("cosine", pa.float64())]))
    marks, rare, prior, blank = idf_marks

    def run(batches):
        index, idf = shared.value
        remembered: dict[tuple, tuple] = {}
        for large in batches:
            for begin in range(0, large.num_rows, QUERIES):
                batch = large.slice(begin, QUERIES)
                rows = list(zip(lists(batch.column("terms"), np.int32), lists(batch.column("counts"), np.int32), numbers(batch.column("other"), np.float64)))
                keys = [(hashlib.blake2b(t.tobytes() + c.tobytes(), digest_size=16).digest(), o) for t, c, o in rows]
                if len(remembered) > 5_000:
                    remembered.clear()
                new = {key: row for key, row in zip(keys, rows) if key not in remembered}
                asked = [(t, _weights(t, c, o, idf, marks, rare)) if len(t) else (t, np.zeros(0)) for t, c, o in new.values()]
                for key, (terms, _), (near, cosines) in zip(new, asked, index.nearest(asked, NEIGHBOURS)):
                    calm = prior if len(terms) and terms[0] < marks else blank
                    votes = cosines**POWER
                    score = (votes @ index.labels[near] + CALM * calm) / (votes.sum() + CALM)
                    why = [{"doc_id": int(index.ids[r]), "toxic": int(index.labels[r]), "cosine": float(c)} for r, c in zip(near[:3], cosines[:3])]
                    remembered[key] = (float(min(1.0, max(0.0, score))), why)
                scores = [remembered[key][0] for key in keys]
                why = [remembered[key][1] for key in keys]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("row"), batch.column("held_out"), pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32()), pa.array(why, evidence)],
                    ["doc_id", "row", "held_out", "score", "predicted", "evidence"],
                )
        released()

    return run


def toxicity(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", row: str | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted, evidence (the three nearest examples), and ``row`` (a long) if named.

    The score is the share of toxic votes among the 15 labelled examples with the largest TF-IDF cosine, each weighted by the 4th
    power of its cosine, drawn towards the prior by a weight of 0.4. All words of the examples are terms, and document frequencies
    are counted over all documents; a word that no example has only adds to its text's length, as one of a single document.
    Words and their first 4 to 7 letters, each also as one that occurs twice and four times (in each thousand words of a longer
    text), are terms once more as far as they go with the label among the examples (log-likelihood gain of 14 or more); these
    have nine tenths of the cosine's weight in texts that hold any.
    Texts without these are drawn towards the share of toxic examples without them, which a text that shares no word with an
    example, also an empty or null one, gets as its score.

    Only labelled rows with a document whose crc32(doc_id as text) mod 5 isn't 0 are examples, at most ``EXAMPLES`` (those with the
    smallest hash of doc_id), each with one text (that with the smallest hash, where a doc_id repeats), so what reaches the driver
    and goes out with the tasks is bounded by that number of texts. Scores depend on the text
    alone. Rows without doc_id are scored, never held out; several labels of a doc_id count as toxic if one is; labels that are
    null or have no document don't count. Without labels every score is 0. Other columns are left out.
    """
    held = F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))
    mark = F.col(row) if row else F.lit(None)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), mark.cast("long").alias("row"), held.alias("held_out"), F.col(text).alias("text"))
    named = labels.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(label).cast("int").alias("toxic"))
    learnt = named.filter("doc_id is not null and toxic is not null and crc32(cast(cast(doc_id as string) as binary)) % 5 <> 0")
    learnt = learnt.groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    learnt = learnt.join(rows.select("doc_id").distinct(), "doc_id", "left_semi")
    learnt = staged(learnt.orderBy(F.xxhash64("doc_id"), "doc_id").limit(EXAMPLES), "labels")
    chosen = F.broadcast(learnt)  # EXAMPLES rows of two numbers at most
    first = F.min(F.struct(F.xxhash64("text").alias("hash"), "text"))["text"].alias("text")
    examples = staged(rows.join(chosen, "doc_id").groupBy("doc_id", "toxic").agg(first), "examples")
    counted = examples.select("text", "toxic").mapInArrow(_counted, "term string, times int, n long, toxic long")
    counted = staged(counted.groupBy("term", "times").agg(F.sum("n").alias("n"), F.sum("toxic").alias("a")), "terms")
    size = learnt.agg(F.count(F.lit(1)), F.sum("toxic")).first()
    total, bad = int(size[0] or 0), int(size[1] or 0)
    number: dict[tuple[str, int], int] = {}
    if 0 < bad < total:
        a, n, p = F.col("a").cast("double"), F.col("n").cast("double"), bad / total
        good = F.when(F.col("a") < F.col("n"), (n - a) * F.log((n - a) / (n * (1 - p)))).otherwise(0.0)
        picked = counted.filter("a > 0").filter((a / n >= max(p, PURE)) & (a * F.log(a / (n * p)) + good >= EVIDENCE)).select("term", "times").collect()
        number = {tuple(r): i for i, r in enumerate(sorted(picked))}
    marks = len(number)
    words = counted.filter("times = 1 and not endswith(term, '-')").select("term").mapInArrow(_named, "hash long").toArrow()
    vocabulary = np.unique(numbers(words.column(0).combine_chunks()).view(np.uint64))
    context = docs.sparkSession.sparkContext
    kinds = "doc_id long, row long, held_out boolean, terms array<int>, counts array<int>, other double"
    vectorised = _vectors(context.broadcast((number, vocabulary)))
    vectors = staged(rows.mapInArrow(vectorised, kinds), "toxicity_vectors", batch=STEP)
    everything = vectors.count()
    rare = math.log((1 + everything) / 2) + 1
    idf = np.full(marks + len(vocabulary), rare)
    held_by = vectors.select("terms").mapInArrow(_held(len(idf)), "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    idf[numbers(held_by.column(0).combine_chunks())] = np.log((1 + everything) / (1 + numbers(held_by.column(1).combine_chunks()))) + 1
    prior = bad / total if total else 0.0
    fitted = examples.select("doc_id", F.lit(None).cast("long").alias("row"), F.lit(False).alias("held_out"), "text").mapInArrow(vectorised, kinds)
    fitted = fitted.join(chosen, "doc_id").select("doc_id", "toxic", "terms", "counts", "other")
    fitted = fitted.orderBy("doc_id").toArrow().combine_chunks()
    ids, toxic, other = (numbers(fitted.column(c).combine_chunks(), k) for c, k in (("doc_id", np.int64), ("toxic", np.int32), ("other", np.float64)))
    terms, counts = (lists(fitted.column(c).combine_chunks(), np.int32) for c in ("terms", "counts"))
    plain = np.array([not len(t) or t[0] >= marks for t in terms], bool)
    blank = (int(toxic[plain].sum()) + CALM * prior) / (int(plain.sum()) + CALM)
    full = [i for i, t in enumerate(terms) if len(t)]
    found = [(terms[i], _weights(terms[i], counts[i], other[i], idf, marks, rare)) for i in full]
    del fitted, terms, counts
    index = BlockMaxIndex(found, toxic[full], ids[full], len(idf))
    del found
    evidence = "array<struct<doc_id: long, toxic: int, cosine: double>>"
    scored = _scored(context.broadcast((index, idf)), (marks, rare, prior, blank))
    out = vectors.mapInArrow(scored, f"doc_id long, row long, held_out boolean, score double, predicted int, evidence {evidence}")
    return out.withColumnRenamed("row", row) if row else out.drop("row")
