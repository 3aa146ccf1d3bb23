"""Periodic runs of words: suffix automaton with link-cut access.

The automaton of a word sequence has a tree of suffix links; the words up to position ``i`` end in one of its
states, and the path from there to the root holds every suffix ending at ``i``. Appending word ``i`` is an access of
that path: it is recoloured with ``i``, and each segment met carries the end ``e`` of the last earlier
occurrence of its strings, the longest of which has ``m`` words. So ``m`` words ending at ``i`` also end
``d = i - e`` words earlier. If ``m >= d`` the two occurrences overlap or touch: a square of period ``d``, which cannot be
extended to the left, as no longer string ends at ``e`` and ``i``. If the next word breaks the period it
is a whole run, of ``m + d`` words. A shorter period would be a later ``e``, so ``d`` is the smallest one.

All words are appended to the tree before the first access, so that it no longer changes. Its paths are then kept as
heavy paths, each with a stack of coloured segments, instead of splay trees; an access recolours the same
segments as a link-cut tree's, of which there are O(n log n) over all accesses.

Before that, stretches of a text that cannot hold a run are set aside with arrays over whole batches. In a run of
period ``q`` and at least ``least_exponent * q`` words, each gram of ``GRAM`` words but the first ``q`` is met again
at most ``q`` words after its last occurrence. So a stretch of ``t`` consecutive grams can only be part of runs of
period up to ``(t + GRAM - 1) / (least_exponent - 1)``, and grams last met longer ago than that split it. Hashes
only ever add stretches; all that is reported comes from the automaton, over the words themselves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from tabstudy.llm import hashing

LEAST_WORDS = 6
LEAST_EXPONENT = 4


class SuffixTree:
    """Suffix automaton of a sequence, with the tree of its suffix links cut into heavy paths."""

    def __init__(self, words: list):
        self.length = [0]
        self.link = [-1]
        self.ends: list[int] = []  # state of every prefix
        self._append_all(words)
        self._cut()

    def _append_all(self, words: list) -> None:
        length, link, ends = self.length, self.link, self.ends
        follow: list[dict] = [{}]
        last = 0
        for word in words:
            state = len(length)
            length.append(length[last] + 1)
            follow.append({})
            p = last
            while p >= 0 and word not in follow[p]:
                follow[p][word] = state
                p = link[p]
            if p < 0:
                link.append(0)
            else:
                q = follow[p][word]
                if length[q] == length[p] + 1:
                    link.append(q)
                else:
                    clone = state + 1
                    link.append(clone)
                    length.append(length[p] + 1)
                    link.append(link[q])
                    follow.append(follow[q].copy())
                    link[q] = clone
                    while p >= 0 and follow[p].get(word) == q:
                        follow[p][word] = clone
                        p = link[p]
            ends.append(state)
            last = state

    def _cut(self) -> None:
        """``head`` of the heavy path of every state; a path's states ascend by length."""
        length, link = self.length, self.link
        order = np.argsort(np.array(length), kind="stable").tolist()
        size = [1] * len(length)
        heavy = [0] * len(length)
        most = [0] * len(length)
        for state in reversed(order[1:]):  # the root is its own parent for none
            parent, below = link[state], size[state]
            size[parent] += below
            if below > most[parent]:
                most[parent] = below
                heavy[parent] = state
        head = list(range(len(length)))
        for state in order[1:]:
            if heavy[link[state]] == state:
                head[state] = head[link[state]]
        self.head = head

    def repetitions(self, least: int) -> Iterator[tuple[int, int, int]]:
        """(end, distance, longest) for every position and segment met with ``longest >= least * distance``."""
        length, link, head = self.length, self.link, self.head
        # per heavy path the segments from the deepest to the one at the head: longest string, last end
        colours: list[list[tuple[int, int]]] = [[] for _ in length]
        for end, state in enumerate(self.ends):
            met: dict[int, int] = {}
            while state > 0:
                top = head[state]
                depth, segments = length[state], colours[top]
                longest = 0
                while segments and segments[-1][0] <= depth:
                    longest, seen = segments.pop()
                    if longest >= least * (end - seen):
                        met[seen] = max(longest, met.get(seen, 0))
                if segments and longest < depth:  # the next one is covered in part
                    seen = segments[-1][1]
                    if depth >= least * (end - seen):
                        met[seen] = max(depth, met.get(seen, 0))
                segments.append((depth, end))
                state = link[top]
            for seen, longest in met.items():
                yield end, end - seen, longest


def runs_of(words: list, least_words: int = LEAST_WORDS, least_exponent: int = LEAST_EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, smallest period) of every maximal run, by start and period."""
    found = []
    for end, period, longest in SuffixTree(words).repetitions(least_exponent - 1):
        n = longest + period
        if n >= least_words and (end + 1 == len(words) or words[end + 1] != words[end + 1 - period]):
            found.append((end + 1 - n, n, period))
    return sorted(found, key=lambda r: (r[0], r[2]))


def gram_words(least_words: int, least_exponent: int) -> int:
    """The longest gram that the shortest run of every period holds twice."""
    return max(1, min(least_words - 1, least_exponent - 1))


def possible_stretches(
    words: np.ndarray, starts: np.ndarray, least_words: int = LEAST_WORDS, least_exponent: int = LEAST_EXPONENT
) -> list[list[tuple[int, int]]]:
    """Per text the stretches [from, to) of its words outside of which no run can lie.

    ``words`` are hashes, ``starts`` the offsets of the texts. A run lies in a single stretch as a whole.
    """
    texts = len(starts) - 1
    out: list[list[tuple[int, int]]] = [[] for _ in range(texts)]
    gram = gram_words(least_words, least_exponent)
    if len(words) < gram:
        return out
    grams = len(words) - gram + 1
    rolled = np.zeros(grams, dtype=np.uint64)
    for j in range(gram):
        rolled = rolled * hashing.GRAM_BASE + words[j : j + grams]
    owner = np.repeat(np.arange(texts), np.diff(starts))
    inside = owner[:grams] == owner[gram - 1 :]
    keys = hashing.mix(rolled ^ hashing.mix(owner[:grams].astype(np.uint64) + np.uint64(1)))
    order = np.argsort(keys, kind="stable")
    again = keys[order[1:]] == keys[order[:-1]]
    gap = np.full(grams, np.iinfo(np.int64).max)
    gap[order[1:][again]] = (order[1:] - order[:-1])[again]
    place = np.flatnonzero(inside & (gap < len(words)))
    while len(place):
        # consecutive grams of one text
        first = np.flatnonzero(np.concatenate([[True], (np.diff(place) != 1) | (np.diff(owner[place]) != 0)]))
        count = np.diff(np.concatenate([first, [len(place)]]))
        period = (count + gram - 1) // (least_exponent - 1)
        fits = gap[place] <= np.repeat(period, count)
        if fits.all():
            break
        place = place[fits]
    if not len(place):
        return out
    begin, end = place[first] - period, place[first] + count - 1 + gram
    text = owner[place[first]]
    for i, a, b in zip(text.tolist(), begin.tolist(), end.tolist(), strict=True):
        origin = int(starts[i])
        a, b = max(0, a - origin), b - origin
        held = out[i]
        while held and held[-1][1] >= a:
            last = held.pop()
            a, b = min(a, last[0]), max(b, last[1])
        held.append((a, b))
    return out


def blank_split_hashes(packed: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word between ASCII white space; word offsets per text."""
    data = np.frombuffer(b" ".join(packed) + b" ", dtype=np.uint8)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    begins = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]]))
    if not len(begins):
        return np.zeros(0, dtype=np.uint64), np.zeros(len(packed) + 1, dtype=np.int64)
    text_starts = hashing.offsets(np.array([len(p) + 1 for p in packed], dtype=np.int64))
    starts = np.searchsorted(begins, text_starts)
    ends = np.flatnonzero(blank & np.concatenate([[False], ~blank[:-1]]))
    sizes = ends - begins
    letters = np.flatnonzero(~blank)
    place = hashing.ramp(sizes)
    terms = hashing.BYTE_CODES[data[letters]] * hashing.powers(int(sizes.max()) + 1, hashing.WORD_BASE)[place]
    return hashing.mix(np.add.reduceat(terms, hashing.offsets(sizes)[:-1])), starts


def text_runs(
    texts: list[str], least_words: int = LEAST_WORDS, least_exponent: int = LEAST_EXPONENT
) -> Iterator[tuple[list[tuple[int, int, int]], list[bytes]]]:
    """Runs and words (in UTF-8) of every text."""
    packed = [t.encode("utf-8", "surrogatepass") for t in texts]
    stretches = possible_stretches(*blank_split_hashes(packed), least_words, least_exponent)
    for data, parts in zip(packed, stretches, strict=True):
        words = data.split()  # bytes split at ASCII white space alone
        runs = []
        for a, b in parts:
            runs += [(a + s, n, q) for s, n, q in runs_of(words[a:b], least_words, least_exponent)]
        yield runs, words


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that lie in the first period of every run that holds them, or in none."""
    if not runs:
        return words
    gone = np.zeros(len(words), dtype=bool)
    for start, n, period in runs:
        gone[start + period : start + n] = True
    return [w for w, g in zip(words, gone.tolist(), strict=True) if not g]


def find_runs(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    least_words: int = LEAST_WORDS,
    least_exponent: int = LEAST_EXPONENT,
    with_text: bool = True,
) -> DataFrame:
    """Maximal periodic runs of the words of every whole text, and the text without their repeats.

    A run is a stretch of at least ``least_words`` words and ``least_exponent`` (2 at least) times its smallest period
    which no neighbouring word extends with that period. Words are what stands between ASCII white space. Returns id,
    ``runs`` (array of start, length, period by start and period), ``runs_sha256`` (over ``start,length,period`` lines),
    ``collapsed`` (words outside of every run's repeats, joined by one space; if ``with_text``) and ``collapsed_sha256``.
    No row leaves its partition; a task holds some texts and the automaton of one stretch.

    Defined cases: a null, empty or blank text has no words and no runs; rows that repeat an id are handled one by
    one; a null id is passed on; an empty table gives an empty table; only the two named columns are read.
    """
    if least_exponent < 2:
        raise ValueError("a run repeats its period at least twice")
    schema = T.StructType([T.StructField(id_column, documents.schema[id_column].dataType)])
    run = T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")])
    schema = schema.add("runs", T.ArrayType(run))
    for name in ("runs_sha256", "collapsed_sha256", *["collapsed"] * with_text):
        schema = schema.add(name, "string")
    run_type = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, texts in hashing.text_batches(batch.column(1).to_pylist()):
                runs, told, digests, kept = [], [], [], []
                for some, words in text_runs(texts, least_words, least_exponent):
                    runs.append([{"start": s, "length": n, "period": q} for s, n, q in some])
                    told.append(hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in some).encode()).hexdigest())
                    left = b" ".join(collapsed(words, some))
                    digests.append(hashlib.sha256(left).hexdigest())
                    if with_text:
                        kept.append(left)
                columns = [batch.column(0).slice(begin, len(texts)), pa.array(runs, run_type)]
                columns += [pa.array(told, pa.string()), pa.array(digests, pa.string())]
                columns += [pa.array(kept, pa.binary()).cast(pa.string())] * with_text
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return documents.select(id_column, text_column).mapInArrow(found, schema)
