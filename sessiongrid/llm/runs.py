"""Periodic runs of words by the method of Kolpakov and Kucherov.

A run is a stretch of words with smallest period q (words q apart are equal) that no neighbour extends keeping q, and
that is long enough: ``least_exponent`` periods and ``least_length`` words. The words are cut into LZ factors, each the
longest stretch that also starts earlier, found by walking a suffix automaton whose states know where they first end.
Runs that touch a border of factors are found from it by Main's algorithm: common extensions of the text with itself
shifted by each period, to both sides, by Z functions over windows as long as the two factors allow. All other runs lie
strictly inside a factor and are copied from its earlier occurrence. All of it takes time linear in the words.

Before that, ``repeated_stretches`` cuts off words that no run can hold: with four periods or more, each five
consecutive words of a run occur in it twice, so only stretches whose five-grams repeat in their text can hold runs. This
drops no run (equal hashes of different five-grams only keep more).

Null and empty texts have no words. Repeated rows are treated alike, each as its own row; a null id has no checksum, so
its text is taken as it is; an empty table gives an empty result; columns other than those named are ignored. A text is
one row of one task: the automaton takes some 600 bytes for each word of a stretch that repeats.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The runs that the operator collapses.
LEAST_EXPONENT, LEAST_LENGTH = 4, 6
#: Consecutive words that occur twice in every run of LEAST_EXPONENT periods and LEAST_LENGTH words.
GRAM = 5


def factors(words: list[int]) -> Iterator[tuple[int, int, int]]:
    """(start, length, start of an earlier occurrence or -1) of the LZ factors, occurrences may overlap the factor.

    The suffix automaton of all words: of a state, ``ends`` is the place where its strings end first. A string read up to
    place j has an earlier occurrence if its state's first end is before j.
    """
    link, length, ends = [-1], [0], [-1]
    moves: list[dict[int, int]] = [{}]
    last = 0
    for i, c in enumerate(words):
        new = len(link)
        length.append(length[last] + 1)
        ends.append(i)
        moves.append({})
        p = last
        while p >= 0 and c not in moves[p]:
            moves[p][c] = new
            p = link[p]
        if p < 0:
            link.append(0)
        else:
            q = moves[p][c]
            if length[p] + 1 == length[q]:
                link.append(q)
            else:
                clone = new + 1
                link += [clone, link[q]]
                length.append(length[p] + 1)
                ends.append(ends[q])
                moves.append(moves[q].copy())
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = clone
                    p = link[p]
                link[q] = clone
        last = new
    n, start = len(words), 0
    while start < n:
        state, j = 0, start
        while j < n:
            after = moves[state][words[j]]
            if ends[after] >= j:
                break
            state, j = after, j + 1
        long = j - start
        if long:
            yield start, long, ends[state] - long + 1
            start = j
        else:
            yield start, 1, -1
            start += 1


def z_function(s: list[int]) -> list[int]:
    """For each place, how far s agrees with itself from there; the whole length at 0."""
    n = len(s)
    z = [0] * n
    if n:
        z[0] = n
    a = b = 0
    for i in range(1, n):
        k = min(z[i - a], b - i) if i < b else 0
        if i + k >= b:
            while i + k < n and s[k] == s[i + k]:
                k += 1
            a, b = i, i + k
        z[i] = k
    return z


def touching(words: list[int], border: int, before: int, behind: int, exponent: int, least: int) -> dict[tuple[int, int], int]:
    """Smallest period by (start, end) of the runs that touch border and end in the factor behind it or just before it.

    before, behind: lengths of the factors on both sides. A run that ends behind the border reaches less than one
    period beyond the factor before, or that factor would be longer; so ``exponent`` periods are less than both factors
    and one period. One that ends at the border itself is sought in the factor before alone.
    """
    most = (before + behind - 1) // (exponent - 1)  # the largest period
    if most < 1 or before + behind + most - 1 < least:
        return {}
    stop = border + behind
    first = max(0, border - before - 2 * most)
    tail, head = words[first:border], words[border : stop + 1]  # one word more tells whether a run ends with the factor
    t, h = len(tail), len(head)
    back = z_function([*tail[::-1], -1, *words[first:stop][::-1]])
    ahead = z_function([*head, -1, *tail, *head])
    found: dict[tuple[int, int], int] = {}

    def note(start: int, end: int, q: int) -> None:
        long = end - start + 1 >= max(exponent * q, least)
        known = end < border and start <= border - before  # touches the border before as well, and was found there
        if long and end < stop and not known:
            found.setdefault((start, end), q)

    for q in range(1, most + 1):
        if q <= behind:  # a whole period behind the border, less than one before it
            left, right = back[t + 1 + behind - q], ahead[q] if q < h else 0
            if left < q:
                note(border - left, border + q + right - 1, q)
        if q <= t:  # a whole period before it
            left, right = back[q] if q < t else 0, ahead[h + 1 + t - q]
            note(border - q - left, border + min(right, h) - 1, q)
    return found


def find_runs(words: list[int], least_exponent: int = LEAST_EXPONENT, least_length: int = LEAST_LENGTH) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start, then period. Words are numbers from 0, the least exponent is 2."""
    at: dict[int, list[tuple[int, int]]] = {}  # (end, period) by start
    before = 0
    for start, length, source in [*factors(words), (len(words), 0, -1)]:
        for (s, e), q in touching(words, start, before, length, least_exponent, least_length).items():
            at.setdefault(s, []).append((e, q))
        if source >= 0:
            shift = start - source
            for s in range(source + 1, source + length - 1):
                for e, q in at.get(s, ()):
                    if e < source + length - 1:
                        at.setdefault(s + shift, []).append((e + shift, q))
        before = length
    return sorted((s, e - s + 1, q) for s, ends in at.items() for e, q in set(ends))


def repeated_stretches(ids: np.ndarray, gram: int = GRAM) -> Iterator[tuple[int, int]]:
    """(start, end) of the longest stretches in which every gram of so many words occurs twice or more in ids."""
    n = len(ids) - gram + 1
    if n < 2:
        return
    hashed = np.zeros(n, np.uint64)
    for k in range(gram):
        hashed = hashed * np.uint64(0x9E3779B97F4A7C15) + ids[k : k + n].astype(np.uint64) + np.uint64(1)
    hashed ^= hashed >> np.uint64(29)
    order = np.argsort(hashed, kind="stable")
    same = hashed[order[1:]] == hashed[order[:-1]]
    again = np.zeros(n + 2, bool)
    again[order[1:][same] + 1] = again[order[:-1][same] + 1] = True
    edges = np.flatnonzero(again[1:] != again[:-1])
    for start, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
        yield start, end + gram - 1


def runs_of(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of LEAST_EXPONENT periods and LEAST_LENGTH words or more."""
    found = []
    for start, end in repeated_stretches(ids):
        if end - start >= LEAST_LENGTH:
            found += [(start + s, n, q) for s, n, q in find_runs(ids[start:end].tolist())]
    return found


def kept_words(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds behind its first period."""
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return [w for w, depth in zip(words, np.cumsum(edge).tolist()) if not depth] if runs else words


class _Numbers(dict):
    """Numbers its keys in the order of their first look-up."""

    def __missing__(self, key: bytes) -> int:
        self[key] = n = len(self)
        return n


def collapse_runs(df: DataFrame, text_col: str = "text") -> DataFrame:
    """df with ``runs``, the array of (start, length, period) by start and period, and ``collapsed``, the kept words
    joined by blanks. Columns of these names are replaced."""
    kept = df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in ("runs", "collapsed")])
    run_type = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
    schema = T.StructType([*kept.schema.fields, T.StructField("runs", T.ArrayType(run_type)), T.StructField("collapsed", T.StringType())])
    place = kept.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("start", "length", "period")
        runs_type = pa.list_(pa.struct([(c, pa.int64()) for c in names]))
        for batch in batches:
            number, runs, collapsed = _Numbers(), [], []
            for text in batch.column(place):
                words = (text.as_py() or "").encode().split()  # of bytes: at blanks and the controls 9 to 13
                found = runs_of(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
                runs.append([dict(zip(names, r)) for r in found])
                collapsed.append(b" ".join(kept_words(words, found)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(runs, runs_type), pa.array(collapsed, pa.binary()).cast(pa.string())], names=schema.names)

    return kept.mapInArrow(run, schema)
