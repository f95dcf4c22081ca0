"""Licence texts in documents: matching statistics of a suffix automaton, chained to spans."""

from __future__ import annotations

from collections import defaultdict
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import raw_texts, texts
from .decontaminate import joined, words_of
from .license_texts import TEMPLATES

# The phrases that always count, and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

LEAST_MATCH = 4  # words of a match that may enter a chain
GAP = 8  # words that two matches of a chain may lie apart
COVERAGE = 0.6  # share of a passage that a chain must cover for its label
SHORT = 20  # a passage of fewer words counts only where all of it stands, word after word


class Automaton(NamedTuple):
    """A generalised suffix automaton over word ids, with what ends in each state."""

    words: dict  # word -> id
    next: list  # state -> {word id: state}
    link: list  # suffix link
    length: list  # longest string of the state
    ends: list  # state -> [(passage, place of its last word)]
    phrases: list  # state -> [(phrase, length)] that are suffixes of its longest string
    whole: list  # the same of short passages
    least: int  # words of the shortest phrase or passage
    sizes: list  # words of each passage
    labels: list  # label of each passage
    phrase_labels: list


def build(templates: dict[str, list[str]], phrases: dict[str, str]) -> Automaton:
    """Extend one automaton with every passage and phrase in turn."""
    words: dict[bytes, int] = {}
    nxt, link, length = [{}], [-1], [0]
    own_ends: dict[int, list] = defaultdict(list)

    def extend(last: int, c: int) -> int:
        if c in nxt[last]:
            q = nxt[last][c]
            return q if length[q] == length[last] + 1 else split(last, c, q)
        new = add(length[last] + 1)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = new
            p = link[p]
        if p < 0:
            link[new] = 0
        else:
            q = nxt[p][c]
            link[new] = q if length[q] == length[p] + 1 else split(p, c, q)
        return new

    def add(n: int) -> int:
        nxt.append({})
        link.append(0)
        length.append(n)
        return len(nxt) - 1

    def split(p: int, c: int, q: int) -> int:
        clone = add(length[p] + 1)
        nxt[clone] = dict(nxt[q])
        link[clone], link[q] = link[q], clone
        while p >= 0 and nxt[p].get(c) == q:
            nxt[p][c] = clone
            p = link[p]
        return clone

    passages = [(label, words_of(t.encode())) for label, ts in templates.items() for t in ts]
    listed = [(label, words_of(p.encode())) for p, label in phrases.items()]
    for number, (_, body) in enumerate([*passages, *listed]):
        last = 0
        for place, word in enumerate(body):
            last = extend(last, words.setdefault(word, len(words)))
            own_ends[last].append((number, place))
    # What ends in a state also ends in those its suffix links lead to.
    ends: list[list] = [[] for _ in nxt]
    for state in sorted(range(len(nxt)), key=length.__getitem__, reverse=True):
        ends[state] += own_ends.get(state, [])
        if link[state] > 0:
            ends[link[state]] += ends[state]
    by_length = sorted(range(1, len(nxt)), key=length.__getitem__)

    def suffixes(bodies: list) -> list[list]:
        here: list[list] = [[] for _ in nxt]
        for i, (_, body) in bodies:
            state = 0
            for word in body:
                state = nxt[state][words[word]]
            here[state].append((i, len(body)))
        for state in by_length:
            here[state] += here[link[state]]
        return here

    n = len(passages)
    short = [(i, p) for i, p in enumerate(passages) if 0 < len(p[1]) < SHORT]
    return Automaton(
        words, nxt, link, length, [[e for e in sorted(set(x)) if e[0] < n] for x in ends],
        suffixes([(i, p) for i, p in enumerate(listed) if p[1]]), suffixes(short),
        min((len(b) for _, b in [*passages, *listed] if b), default=1),
        [len(b) for _, b in passages], [label for label, _ in passages], [label for label, _ in listed],
    )


def matches(words: list[bytes], a: Automaton, whole: list | None = None):
    """Base places ``(start, phrase)`` and the right-maximal matches ``(end, length, state)`` of a text.

    Places ``(start, end, passage)`` of short passages are added to ``whole``.

    The longest match that ends at each word is followed through the automaton. A word that no
    passage has breaks every match, so only runs of known words are walked.
    """
    known = np.array(list(map(a.words.get, words, [-1] * len(words))), np.int64)
    inside = np.flatnonzero(np.diff(np.r_[False, known >= 0, False]))
    base, found = [], []
    for first, beyond in zip(inside[::2].tolist(), inside[1::2].tolist()):
        if beyond - first < a.least:
            continue
        state = long = 0
        for i, c in enumerate(known[first:beyond].tolist(), first):
            before = state, long
            while state and c not in a.next[state]:
                state = a.link[state]
                long = a.length[state]
            if c in a.next[state]:
                state, long = a.next[state][c], long + 1
            if long <= before[1] and before[1] >= LEAST_MATCH:
                found.append((i, before[1], before[0]))
            for phrase, size in a.phrases[state]:
                if size <= long:
                    base.append((i + 1 - size, phrase))
            if whole is not None:
                whole += [(i + 1 - size, i + 1, passage) for passage, size in a.whole[state] if size <= long]
        if long >= LEAST_MATCH:
            found.append((beyond, long, state))
    return base, found


def chains(found: list, a: Automaton) -> dict[int, tuple[int, int, int]]:
    """Per passage the best chain as (covered words, first word, beyond its last).

    Matches of a chain follow each other in the text and in the passage, at most GAP words apart.
    """
    by_passage = defaultdict(list)
    for end, long, state in found:
        for passage, place in a.ends[state]:
            by_passage[passage].append((end - long, end, place + 1 - long, place + 1))
    best = {}
    for passage, pieces in by_passage.items():
        pieces.sort()
        done: list[tuple] = []
        for s, e, ps, pe in pieces:
            covered, start = e - s, s
            for s2, e2, ps2, pe2, c2, start2 in reversed(done):
                if s2 + a.sizes[passage] + GAP < s:
                    break  # no earlier match reaches this one
                skip = max(0, e2 - s, pe2 - ps)
                if s2 < s and ps2 < ps and s - e2 <= GAP and ps - pe2 <= GAP and skip < e - s:
                    if c2 + e - s - skip > covered:
                        covered, start = c2 + e - s - skip, start2
            done.append((s, e, ps, pe, covered, start))
        top = max(done, key=lambda d: (d[4], d[5] - d[1], -d[5]))  # most words, then the closest, then the first
        best[passage] = (top[4], top[5], top[1])
    return best


def labelled(found: list, whole: list, a: Automaton) -> tuple[list, float]:
    """Spans ``(label, first, beyond)`` of passages, and the largest share of a passage that stands.

    A short passage counts where it stands whole: families of licences differ by single words. A long
    one counts if a chain covers enough of it, unless a passage of another label covers more words of
    the same place, as the notices of one family nearly cover each other.
    """
    long, share = [], 0.0
    for passage, (covered, first, beyond) in sorted(chains(found, a).items()):
        size = a.sizes[passage]
        part = covered / (size if size >= SHORT else max(size, beyond - first))
        share = max(share, min(1.0, part))
        if size >= SHORT and part >= COVERAGE:
            long.append((a.labels[passage], first, beyond, covered))
    kept = [
        (label, first, beyond) for label, first, beyond, covered in long
        if not any(o[0] != label and o[1] <= first and beyond <= o[2] and o[3] > covered for o in long)
    ]
    return kept + [(a.labels[p], first, beyond) for first, beyond, p in whole], 1.0 if whole else share


def scan(text: bytes | None, a: Automaton) -> dict:
    """What one text has: base places, labelled spans and the best coverage."""
    words = words_of(text)
    whole: list = []
    base, found = matches(words, a, whole) if words else ([], [])
    spans, share = labelled(found, whole, a)
    score = 1.0 if base else share
    starts = [s for s, _ in base]
    base_labels = {a.phrase_labels[p] for _, p in base}
    return {
        "n_words": len(words), "n_base": len(base),
        "first_word": min(starts, default=None), "last_word": max(starts, default=None),
        "base_labels": sorted(base_labels), "labels": sorted(base_labels | {s[0] for s in spans}),
        "spans": [{"label": x, "a": i, "b": j} for x in sorted({s[0] for s in spans})
                  for i, j in joined([s[1:] for s in spans if s[0] == x])],
        "score": score,
    }


def scan_licenses(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    templates: dict[str, list[str]] = TEMPLATES,
    phrases: dict[str, str] = PHRASES,
) -> DataFrame:
    """Licence phrases and licence passages in every row.

    Returns ``doc_id, n_words, n_base`` (places of a phrase), ``first_word, last_word`` (their
    smallest and largest start, else null), ``base_labels, labels`` (sorted lists; the second also
    has those of passages), ``spans`` (label and words [a, b) of a passage of under SHORT
    words that stands whole, or of a chain that covers enough of a longer one) and ``score``: 1 if a
    phrase or a whole short passage stands in the text, else the largest share of a passage that one
    chain covers. Where chains of several labels lie in the same words, the one that covers most of
    them counts; equal ones all do. Null and empty texts have no words and score 0. One scan, no shuffle:
    texts are streamed, and the automaton is as large as the given licences.
    """
    sent = docs.sparkSession.sparkContext.broadcast(tuple(build(templates, phrases)))
    slim = texts(docs, doc_id, text)

    def run(batches):
        automaton = Automaton(*sent.value)
        for batch in batches:
            found = [scan(t, automaton) for t in raw_texts(batch["text"])]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], *(pa.array([f[n] for f in found], k) for n, k in SHAPE.items())],
                names=["doc_id", *SHAPE],
            )

    kind = dict(slim.dtypes)["doc_id"]
    return slim.mapInArrow(
        run,
        f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels array<string>, "
        "labels array<string>, spans array<struct<label:string,a:int,b:int>>, score double",
    )


SHAPE = {
    "n_words": pa.int64(), "n_base": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64(),
    "base_labels": pa.list_(pa.string()), "labels": pa.list_(pa.string()),
    "spans": pa.list_(pa.struct([("label", pa.string()), ("a", pa.int32()), ("b", pa.int32())])),
    "score": pa.float64(),
}
