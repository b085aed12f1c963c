"""Passages of evaluation items inside a corpus.

Documents are read in shards (some hundred thousand words of one task). Of each shard the suffix array is built over word
numbers: all suffixes that begin with a word any item has, ordered to the length of the longest passage. Every suffix of every
passage is looked up by binary search, word by word deeper, until nothing of the shard begins with it: that gives its longest
verbatim matches with their locations, and with every shorter prefix the other locations and how far each of them agrees.
Matches are chained to stretches across changed words and markup, and the best one or two stretches, in order, must hold the
asked share of the passage. No shuffle: the corpus is read and its words are numbered once, and only found pairs come out.

What a stretch is, is stated by the constants: matches of at least SEED words, between two of which at most WITHIN words of the
passage lie; at its ends up to ENDS further changed words. A text that agrees with a passage in no three words running, or whose
changes lie closer than that, isn't found.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections import deque
from collections.abc import Iterator, Sequence
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricequarry.functions.columns import exact

SEED = 3  # words of the shortest match that counts; a shorter passage must stand whole
CHANGED = 2  # words that may differ between two matches of a stretch
WITHIN = 8  # words that may lie between two matches of a stretch, if most of them are the same
ENDS = 1  # changed words at either end of a stretch, each followed by one or two that agree
INSERTED = 15  # words that markup may put between two matches of a stretch
ALIKE = 0.7  # share of a stretch's words that must be the same
ALTERNATIVES = 8  # matches that end at the same word of the passage, the last of which a further one may follow
MANY = 256  # matches of a document and an item beyond which they are compared without looking at bounds first
FEW = 8  # words of a stretch of which no share need be the same
PART = 200_000  # matches of which bounds are computed together
HITS = 4_000_000  # locations that are looked at together
WORD = re.compile(r"[^\W_]+")
INVISIBLE = re.compile("[­​-‏⁠﻿]")
# (what the text must hold for the pattern to match, pattern, what it is replaced by)
MARKUP = (
    ("<", re.compile(r"</?(?:b|i|u|s|em|strong|span|small|big|sub|sup|nowiki|font|tt|code)\b[^<>]*>", re.I), ""),
    ("<", re.compile(r"<!--|</?[a-zA-Z][^<>]*>"), " "),
    ("[[", re.compile(r"\[\[[^\[\]|]*\|"), ""),
    ("[[", re.compile(r"\[\["), ""),
    ("]]", re.compile(r"\]\]"), ""),
    ("''", re.compile(r"'{2,}"), ""),
    ("//", re.compile(r"\[(?:https?:)?//[^\s\]]+"), " "),
    ("{{", re.compile(r"\{\{\s*[\w /:-]{1,40}\s*\}\}"), " "),
    ("{{", re.compile(r"\{\{\s*[\w /:-]{1,40}\s*\|(?:\s*[\w-]{1,20}\s*=)?"), " "),
    ("|", re.compile(r"\|\s*[\w-]{1,20}\s*="), " "),
)


def passage_words(text: str | None) -> list[str]:
    """The words of a text without markup, case, spacing and punctuation; what stands in comments and templates is kept."""
    if not text:
        return []
    if "&" in text:
        text = html.unescape(text)
    if not text.isascii():
        text = unicodedata.normalize("NFKC", INVISIBLE.sub("", text))
    for needed, pattern, by in MARKUP:
        if needed in text:
            text = pattern.sub(by, text)
    return WORD.findall(text.lower())


class Passages:
    """Items as word numbers from 1; 0 is any word that no item has."""

    def __init__(self, items: Sequence[tuple[int, Sequence[str]]]) -> None:
        self.ids, self.words = [], []
        self.number: dict[str, int] = {}
        for item_id, ws in items:
            if ws:
                self.ids.append(item_id)
                self.words.append(np.array([self.number.setdefault(w, len(self.number) + 1) for w in ws], np.uint32))
        self.size = np.array([len(w) for w in self.words], np.int64)
        self.longest = int(self.size.max(initial=0))
        # all passages one after the other, each with a 0 behind it
        self.flat = np.concatenate([np.r_[w, np.uint32(0)] for w in self.words]) if self.words else np.empty(0, np.uint32)
        first = np.cumsum(self.size + 1) - self.size - 1
        # the suffixes that are looked up: where they begin, of which item, at which word, how long they are
        self.item = np.repeat(np.arange(len(self.size)), self.size)
        self.at = np.arange(len(self.item)) - np.repeat(np.cumsum(self.size) - self.size, self.size)
        self.begin = first[self.item] + self.at
        self.left = self.size[self.item] - self.at
        self.least = np.minimum(SEED, self.size[self.item])
        asked = self.left >= self.least
        self.item, self.at, self.begin, self.left, self.least = (x[asked] for x in (self.item, self.at, self.begin, self.left, self.least))

        # which words an item has, by the last bits of their numbers: says yes too often, never no too often
        bits = 12
        while bits > 8 and len(self.size) << bits > 1 << 26:
            bits -= 1
        self.mask = (1 << bits) - 1
        self.has = np.zeros((len(self.size), 1 << bits), bool)
        if len(self.size):
            self.has[np.repeat(np.arange(len(self.size)), self.size), np.concatenate(self.words) & self.mask] = True

    def numbers(self, words: Sequence[str]) -> np.ndarray:
        return np.array(list(map(self.number.get, words, repeat(0))), np.uint32)


def suffix_array(numbers: np.ndarray, longest: int) -> np.ndarray:
    """The positions of words other than 0, in the order of the text from there on, to ``longest`` words. No two 0 are the same,
    so that nothing agrees beyond one; the last number must be 0. Ranks of the first h words give those of the first 2h."""
    n = len(numbers)
    zero = np.flatnonzero(numbers == 0)
    rank = numbers.astype(np.int64)
    rank[zero] = n + np.arange(len(zero))
    order = np.flatnonzero(numbers)
    order = order[np.argsort(rank[order], kind="stable")]
    slots, first, second = np.arange(len(order)), rank[order], np.zeros(len(order), np.int64)
    h = 1
    while len(slots):
        pos = order[slots]
        fresh = np.r_[True, (np.diff(first) != 0) | (np.diff(second) != 0)]
        start = np.maximum.accumulate(np.where(fresh, slots, 0))
        rank[pos] = start
        alone = fresh & np.r_[fresh[1:], True]
        slots = slots[~alone]
        if h >= longest or not len(slots):
            return order
        pos = order[slots]
        key = rank[pos] * (2 * n) + rank[pos + h]
        by = np.argsort(key, kind="stable")
        order[slots] = pos[by]
        first, second = key[by] // (2 * n), key[by] % (2 * n)
        h *= 2
    return order


class Shard:
    """The suffix array of some documents' words, each document with a 0 behind it."""

    def __init__(self, numbers: np.ndarray, passages: Passages) -> None:
        self.passages = passages
        self.order = suffix_array(numbers, passages.longest) if len(numbers) else np.empty(0, np.int64)
        self.text = numbers.astype(np.int64)
        self.text[self.text == 0] = 1 << 40  # behind all words, as in the suffix array

    def _bound(self, lo: np.ndarray, hi: np.ndarray, depth: int, word: np.ndarray) -> np.ndarray:
        """Binary search: the first slot between lo and hi whose suffix has at ``depth`` a word not less than ``word``."""
        lo, hi = lo.copy(), hi.copy()
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                return lo
            mid = (lo[open_] + hi[open_]) >> 1
            less = self.text[self.order[mid] + depth] < word[open_]
            lo[open_] = np.where(less, mid + 1, lo[open_])
            hi[open_] = np.where(less, hi[open_], mid)

    def matches(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(suffix of a passage, location, words that agree) of all verbatim matches that can't be made longer at either end,
        those of an item together, in parts of about HITS locations."""
        p = self.passages
        q = np.arange(len(p.begin))
        first = self.text[self.order]
        word = p.flat[p.begin].astype(np.int64)
        lo, hi = np.searchsorted(first, word, "left"), np.searchsorted(first, word, "right")
        depth, found = 1, []  # found: (suffix, slots from, to, words that agree)
        while len(q):
            some = lo < hi
            q, lo, hi = q[some], lo[some], hi[some]
            more = p.left[q] > depth
            low, high = hi.copy(), hi.copy()  # what goes on agreeing: nothing, where the passage ends
            word = p.flat[p.begin[q[more]] + depth].astype(np.int64)
            low[more] = self._bound(lo[more], hi[more], depth, word)
            high[more] = self._bound(low[more], hi[more], depth, word + 1)
            told = p.least[q] <= depth
            for a, b in ((lo, low), (high, hi)):
                part = told & (a < b)
                found.append((q[part], a[part], b[part], np.full(int(part.sum()), depth)))
            q, lo, hi = q[more], low[more], high[more]
            depth += 1
        q, a, b, n = (np.concatenate(x) for x in zip(*found, strict=True)) if found else [np.empty(0, np.int64)] * 4
        by = np.argsort(p.item[q], kind="stable")
        q, a, b, n = q[by], a[by], b[by], n[by]
        upto = np.cumsum(b - a)
        # parts end where an item ends
        ends = np.flatnonzero(np.r_[np.diff(p.item[q]) != 0, True]) + 1 if len(q) else np.empty(0, np.int64)
        begin = done = 0
        for end in ends:
            if upto[end - 1] - done >= HITS or end == len(q):
                yield self._located(q[begin:end], a[begin:end], b[begin:end], n[begin:end])
                begin, done = end, upto[end - 1]

    def _located(self, q: np.ndarray, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All slots of the ranges, but for those where the words before agree too: these are inside a longer match."""
        p, out = self.passages, []
        upto = np.cumsum(b - a)
        cuts = np.searchsorted(upto, np.arange(HITS, upto[-1] if len(upto) else 0, HITS))
        for i, j in zip(np.r_[0, cuts], np.r_[cuts, len(q)], strict=True):
            size = b[i:j] - a[i:j]
            slot = np.repeat(a[i:j] - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
            where, mine = self.order[slot], np.repeat(q[i:j], size)
            inner = (p.at[mine] > 0) & (where > 0) & (self.text[where - 1] == p.flat[p.begin[mine] - 1])
            out.append((mine[~inner], where[~inner], np.repeat(n[i:j], size)[~inner]))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def common(a: Sequence[int], b: Sequence[int]) -> int:
    """Words in the longest common subsequence."""
    row = [0] * (len(b) + 1)
    for x in a:
        left = 0
        for j, y in enumerate(b, 1):
            left, row[j] = row[j], left + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def extend(item: list[int], doc: list[int], i: int, j: int) -> tuple[int, int]:
    """How many words of both follow (i, j) as one stretch, across up to ENDS words that are changed, left out or put in."""
    n, m = i, j
    for _ in range(ENDS):
        for di, dj in ((1, 1), (1, 0), (0, 1)):
            k = min(SEED - 1, len(item) - n - di)
            if k > 0 and item[n + di : n + di + k] == doc[m + dj : m + dj + k]:
                n, m = n + di + k, m + dj + k
                break
        else:
            break
        while n < len(item) and m < len(doc) and item[n] == doc[m]:
            n, m = n + 1, m + 1
    return n - i, m - j


MOST_AT_END = ENDS * SEED  # words of the passage that ``extend`` can add, but for a match that is a match of its own


def joins(item: list[int], doc: list[int]) -> bool:
    """Whether what lies between two matches is the same text with single words changed: a third of them at most, and one."""
    return len(item) <= CHANGED or (len(item) <= WITHIN and len(item) - common(item, doc) <= 1 + len(item) // 3)


def stretches(runs: list[tuple[int, int, int]], doc: np.ndarray, item: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(first and last word in the passage, first and last in the document) of the matches (document, passage, length) and of their
    maximal chains.

    A chain counts if the share ``ALIKE`` of its words of the passage are in the document's stretch in order.
    """
    doc, item = doc.tolist(), item.tolist()
    whole = max(runs, key=lambda r: r[2])
    if whole[2] == len(item):
        return [(0, len(item) - 1, whole[0], whole[0] + len(item) - 1)]
    runs = sorted(runs)
    best: list[tuple[int, int]] = []  # where the chain that ends with the run begins in passage and document
    last = set(range(len(runs)))
    # by the word of the passage behind them, the last matches that end there: where a phrase is repeated, the others do no better
    behind: dict[int, deque[int]] = {}
    for i, (d, p, n) in enumerate(runs):
        mine, by = (p, d), None
        for e in range(max(1, p - WITHIN), p + n):
            for j in behind.get(e, ()):
                d0, p0, n0 = runs[j]
                if p > p0 and d > d0 and d - d0 - n0 <= INSERTED + WITHIN and d + n > d0 + n0 and best[j][0] < mine[0]:
                    if joins(item[e:p], doc[d0 + n0 : d]):
                        mine, by = best[j], j
        best.append(mine)
        last.discard(by)
        behind.setdefault(p + n, deque(maxlen=ALTERNATIVES)).append(i)
    out = {(p, p + n - 1, d, d + n - 1) for d, p, n in runs}
    for i in sorted(last):
        (p0, d0), (d, p, n) = best[i], runs[i]
        left = extend(item[:p0][::-1], doc[max(0, d0 - 2 * SEED) : d0][::-1], 0, 0)
        right = extend(item, doc, p + n, d + n)
        s = (p0 - left[0], p + n - 1 + right[0], d0 - left[1], d + n - 1 + right[1])
        size = s[1] - s[0] + 1
        if size == n or size <= FEW or common(item[s[0] : s[1] + 1], doc[s[2] : s[3] + 1]) >= ALIKE * size:
            out.add(s)
            if size == len(item):
                return [s]
    return sorted(out, key=lambda s: (s[2], s))


def held(found: list[tuple[int, int, int, int]]) -> int:
    """Words of the passage in the best one or two stretches in order, of those that ``stretches`` gives."""
    top, ended = 0, sorted(found, key=lambda s: s[3])
    begins = np.full(max((b for _, b, _, _ in found), default=0) + 1, 1 << 40)  # by last word in the passage: the first, of what ended in the document
    n = 0
    for c, d, u, _ in found:  # in order of the document
        while n < len(ended) and ended[n][3] < u:
            a, b = ended[n][:2]
            begins[b] = min(begins[b], a)
            n += 1
        top = max(top, d - c + 1)
        b = np.flatnonzero(begins[:d] < c)
        if len(b):
            top = max(top, int((b - begins[b] + 1 + d - np.maximum(c - 1, b)).max()))
    return top


def leaks(docs: Sequence[np.ndarray], passages: Passages, share: float) -> list[tuple[int, int, int, int]]:
    """(document, item index, words held, longest verbatim match) of every document that holds ``share`` of a passage."""
    if not docs:
        return []
    text = np.concatenate([np.r_[d, np.uint32(0)] for d in docs])
    shard = Shard(text, passages)
    begin = np.r_[0, np.cumsum([len(d) + 1 for d in docs])]
    out = []
    for q, where, n in shard.matches():
        if len(q):
            out += _leaks(docs, text, begin, passages, q, where, n, share)
    return out


def chains(where: np.ndarray, at: np.ndarray, n: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of matches in order of pair and location: (those that no other can follow in a stretch, where in the passage and where in
    the document the chains of matches that end with them begin at the earliest)."""
    before, after, end = [], [], where + n
    near = np.arange(len(where))
    step = 1
    while len(near):
        near = near[near + step < len(where)]
        j = near + step
        near = near[(pair[j] == pair[near]) & (where[j] - end[near] <= INSERTED + WITHIN)]
        j = near + step
        gap = at[j] - at[near] - n[near]
        follows = (at[j] > at[near]) & (gap <= WITHIN) & (gap > -n[j]) & (where[j] > where[near]) & (end[j] > end[near])
        before.append(near[follows])
        after.append(j[follows])
        step += 1
    i, j = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (before, after))
    begins, first = at.copy(), where.copy()
    while True:
        earlier, lower = begins.copy(), first.copy()
        np.minimum.at(earlier, j, begins[i])
        np.minimum.at(lower, j, first[i])
        if (earlier == begins).all() and (lower == first).all():
            break
        begins, first = earlier, lower
    ends = np.ones(len(where), bool)
    ends[i] = False
    ends = np.flatnonzero(ends)
    return ends, begins[ends], first[ends]


def best_two(most: np.ndarray, of: np.ndarray, pairs: int) -> np.ndarray:
    """The sum of the two largest by pair."""
    by = np.lexsort((-most, of))
    lead = np.flatnonzero(np.r_[True, np.diff(of[by]) != 0])
    more = np.r_[of[by][1:] == of[by][:-1], False][lead]
    out = np.zeros(pairs)
    if not len(most):
        return out
    out[of[by][lead]] = most[by][lead] + np.where(more, np.r_[most[by][1:], 0][lead], 0)
    return out


def bounds(text: np.ndarray, begin: np.ndarray, passages: Passages, where: np.ndarray, doc: np.ndarray, item: np.ndarray, at: np.ndarray, n: np.ndarray, need: np.ndarray) -> np.ndarray:
    """Of matches in order of document, item and location: by pair of document and item, the most words that can be held."""
    of = np.cumsum(np.r_[True, (doc[1:] != doc[:-1]) | (item[1:] != item[:-1])]) - 1
    # two chains, with what may be added at their ends
    ends, begins, low = chains(where, at, n, of)
    most = (at + n)[ends] - begins + 2 * MOST_AT_END
    bound = best_two(most, of[ends], len(need))
    asked = (bound >= need)[of[ends]]
    ends, low, most = ends[asked], low[asked], most[asked]
    # and no more than there are words of the passage around them, a share of ALIKE of which a stretch consists
    lo = np.maximum(low - MOST_AT_END - ENDS, begin[doc[ends]])
    hi = np.minimum((where + n)[ends] + MOST_AT_END + ENDS, begin[doc[ends] + 1] - 1)
    most = np.minimum(most, np.maximum(words_around(text, lo, hi, item[ends], passages) / ALIKE, FEW))
    return np.minimum(bound, best_two(most, of[ends], len(need))) if len(ends) else np.zeros(len(need))


def words_around(text: np.ndarray, lo: np.ndarray, hi: np.ndarray, item: np.ndarray, passages: Passages) -> np.ndarray:
    """How many words from lo to hi may be words of the item."""
    out = np.zeros(len(lo), np.int64)
    size = hi - lo
    upto = np.cumsum(size)
    cuts = np.searchsorted(upto, np.arange(HITS, upto[-1] if len(upto) else 0, HITS))
    for i, j in zip(np.r_[0, cuts], np.r_[cuts, len(lo)], strict=True):
        k = size[i:j]
        at = np.repeat(lo[i:j] - np.cumsum(k) + k, k) + np.arange(int(k.sum()))
        word = text[at]
        yes = (word > 0) & passages.has[np.repeat(item[i:j], k), word & passages.mask]
        out[i:j] = np.bincount(np.repeat(np.arange(j - i), k), weights=yes, minlength=j - i)
    return out


def _leaks(docs: Sequence[np.ndarray], text: np.ndarray, begin: np.ndarray, passages: Passages, q: np.ndarray, where: np.ndarray, n: np.ndarray, share: float) -> list[tuple[int, int, int, int]]:
    doc, item, at = np.searchsorted(begin, where, "right") - 1, passages.item[q], passages.at[q]
    order = np.lexsort((where, item, doc))
    where, doc, item, at, n = where[order], doc[order], item[order], at[order], n[order]
    new_pair = np.r_[True, (doc[1:] != doc[:-1]) | (item[1:] != item[:-1])]
    # matches that are too far apart in the document can't be in one stretch
    pair = np.flatnonzero(new_pair)
    need = share * passages.size[item[pair]]
    stop = np.r_[pair[1:], len(doc)]
    bound = np.full(len(pair), np.inf)
    few = stop - pair <= MANY
    upto = np.cumsum(np.where(few, stop - pair, 0))
    for k in range(0, int(upto[-1]) + 1, PART):
        mine = np.flatnonzero(few & (upto > k) & (upto <= k + PART))
        if len(mine):
            rows = np.flatnonzero(np.repeat(np.isin(np.arange(len(pair)), mine, assume_unique=True), stop - pair))
            bound[mine] = bounds(text, begin, passages, where[rows], doc[rows], item[rows], at[rows], n[rows], need[mine])
    out = []
    for k in np.flatnonzero(bound >= need):
        lo, hi = pair[k], stop[k]
        d, i = int(doc[lo]), int(item[lo])
        runs = list(zip((where[lo:hi] - begin[d]).tolist(), at[lo:hi].tolist(), n[lo:hi].tolist(), strict=True))
        got = held(stretches(runs, docs[d], passages.words[i]))
        if got >= need[k]:
            out.append((d, i, got, int(n[lo:hi].max())))
    return out


def blocks(items: Iterator[tuple[int, str]], most: int) -> Iterator[list[tuple[int, list[str]]]]:
    """The items with their words, in blocks of at most ``most`` words, a longer item in a block of its own."""
    block: list[tuple[int, list[str]]] = []
    filled = 0
    for i, p in items:
        ws = passage_words(p)
        if block and filled + len(ws) > most:
            yield block
            block, filled = [], 0
        block.append((i, ws))
        filled += len(ws)
    yield block


FOUND = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("n_words", pa.int32()), ("n_held", pa.int32()), ("longest", pa.int32())])


def find_leaks(
    documents: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", passage: str = "passage",
    share: float = 0.5, shard_words: int = 500_000, block_words: int = 4_000_000,
) -> DataFrame:
    """(doc_id, item_id, n_words, n_held, longest): documents that hold at least ``share`` of an item's words, in order.

    ``n_held`` is what the best one or two stretches hold. The corpus is read once for all items; a set of more than
    ``block_words`` words, which tasks can't hold together, is taken in blocks, each compared with all documents.

    Null and empty texts and passages hold nothing; a passage of fewer than three words must stand whole; repeated documents and
    items each give their rows.
    """
    documents = exact(documents, [doc_id, text]).toDF("_id", "_text").select(F.col("_id").cast("long"), "_text").filter("_text is not null")
    items = exact(items, [item_id, passage]).toDF("_id", "_passage").select(F.col("_id").cast("long"), "_passage").filter("_passage is not null")
    out = None
    for block in blocks(((r[0], r[1]) for r in items.toLocalIterator()), block_words):
        sent = documents.sparkSession.sparkContext.broadcast(block)  # at most block_words words

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            passages = Passages(sent.value)

            def found(ids: list[int], docs: list[np.ndarray]) -> pa.RecordBatch:
                rows = [(ids[d], passages.ids[i], int(passages.size[i]), n, k) for d, i, n, k in leaks(docs, passages, share)]
                return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True) if rows else [[]] * 5, FOUND, strict=True)], schema=FOUND)

            ids: list[int] = []
            docs: list[np.ndarray] = []
            n = 0
            for batch in batches:
                for i, t in zip(batch.column(0), batch.column(1), strict=True):
                    numbers = passages.numbers(passage_words(t.as_py()))
                    if numbers.any():
                        ids.append(i.as_py())
                        docs.append(numbers)
                        n += len(numbers)
                    if n >= shard_words:
                        yield found(ids, docs)
                        ids, docs, n = [], [], 0
            yield found(ids, docs)

        part = documents.mapInArrow(run, "doc_id long, item_id long, n_words int, n_held int, longest int")
        out = part if out is None else out.unionByName(part)
    return out


def without_leaks(documents: DataFrame, found: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The documents that hold no passage."""
    return documents.join(found.select(F.col("doc_id").alias(doc_id)).distinct(), doc_id, "left_anti")
