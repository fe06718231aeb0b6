"""License scans by a positional rare-token index.

The index holds, for every rare word of the templates, its inverse document frequency over them and all its
places (template, position). A file is read in windows of WINDOW words; of each window the TOP licence words of
the highest IDF are looked up, and nowhere more, so every stretch of a long file has its own. Templates shorter than
SHORT words, which a window's best words might pass by, are anchored by their rarest word, which is looked up
wherever it stands.

Each occurrence votes for an alignment (template, start); postings are intersected by relative position, as the
words of one copy agree on the start up to DRIFT words that were put in or left out. Alignments with enough votes are
verified: the template's words that stand in their places, give or take DRIFT, must have MIN_SHARE of its weight (that
is the score), and its mandatory phrases must stand there word by word. Of alignments that lie at one place the
longest counts. A phrase alone is a template of its own (`PHRASES`, the base), of which every place counts.

The templates are the public texts of `license_texts`; others may be given.

* Null and empty texts have no word and no label; texts are read whole, however long.
* Every place of a base phrase counts, also repeated and overlapping ones. Repeated rows are scanned each on
  its own. Ties: of several alignments with one label the largest share is the score; of alignments of one length
  at one place the first template counts.
* Only the id and the text are read, so other columns may have any name. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from colloquy.llm import textnum as T
from colloquy.llm.license_texts import TEXTS


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    #: Phrases of the text that must stand in their places; the whole, if none is named.
    mandatory: tuple[str, ...] = ()

    @property
    def words(self) -> list[str]:
        return split(self.text)


def split(text: str) -> list[str]:
    """Words as files are cut into them."""
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))


PHRASES = (Template("mit", "mit license"), Template("apache", "apache license"), Template("gpl", "general public license"))
TEMPLATES = tuple(Template(*t) for t in TEXTS)
#: A word that more templates have is never looked up, unless it is an anchor.
RARE_TEMPLATES = 3
WINDOW, TOP, SHORT = 64, 16, 24
DRIFT = 6
MIN_SHARE = 0.5
#: Places of a template that must have a vote; of one shorter than SHORT its anchor will do.
LEAST_VOTES = 3
FOUND = "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double"


class Index:
    def __init__(self, phrases: tuple[Template, ...] = PHRASES, templates: tuple[Template, ...] = TEMPLATES):
        self.templates, self.n_base = [*phrases, *templates], len(phrases)
        texts = [t.words for t in self.templates]
        frequency = Counter(w for words in texts for w in set(words))
        vocabulary = sorted(frequency)
        hashes = np.concatenate([p.hashes(p.offs[:-1], p.offs[1:], T.BYTES_LOWER) for p in T.slices(pa.array(vocabulary))])
        order = np.argsort(hashes)
        self.hashes, number = hashes[order], {vocabulary[k]: at for at, k in enumerate(order)}
        self.codes = [np.array([number[w] for w in words]) for words in texts]
        self.idf = np.zeros(len(vocabulary))
        for w, n in frequency.items():
            self.idf[number[w]] = math.log(1 + len(texts) / n)
        self.is_rare, self.is_anchor = np.zeros((2, len(vocabulary) + 1), bool)  # the last is no word of the index
        self.is_rare[[number[w] for w, n in frequency.items() if n <= RARE_TEMPLATES]] = True
        self.is_anchor[[max(set(codes.tolist()), key=lambda c: (self.idf[c], -c)) for codes in self.codes if len(codes) < SHORT]] = True
        # places of each word that is looked up, one word after the other
        places = sorted((c, k, at) for k, codes in enumerate(self.codes) for at, c in enumerate(codes.tolist()) if self.is_rare[c] or self.is_anchor[c])
        self.template, self.at = np.array([p[1] for p in places]), np.array([p[2] for p in places])
        self.begin = np.searchsorted(np.array([p[0] for p in places]), np.arange(len(vocabulary) + 2))
        self.checks = [[(self._place(words, p), self.codes[k][self._place(words, p) :][: len(p)]) for p in [split(m) for m in self.templates[k].mandatory] or [words]] for k, words in enumerate(texts)]

    @staticmethod
    def _place(words: list[str], phrase: list[str]) -> int:
        return next(k for k in range(len(words)) if words[k : k + len(phrase)] == phrase)

    def encode(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of words in the templates' vocabulary, -1 for others."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, at, -1)

    def looked_up(self, codes: np.ndarray, text: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Which words are looked up: in each window of a file the occurrences of its TOP words by IDF, and all anchors."""
        word = np.flatnonzero(self.is_rare[codes])
        window = (text[word] << 40) + (word - first[text[word]]) // WINDOW
        order = np.lexsort((codes[word], -self.idf[codes[word]], window))
        word, window = word[order], window[order]
        opens = np.ones(len(word), bool)
        opens[1:] = window[1:] != window[:-1]
        other = opens.copy()
        other[1:] |= codes[word[1:]] != codes[word[:-1]]
        rank = np.cumsum(other)
        rank -= np.repeat(rank[opens], np.diff(np.append(np.flatnonzero(opens), len(word))))
        out = self.is_anchor[codes]
        out[word[rank < TOP]] = True
        return np.flatnonzero(out)

    def votes(self, codes: np.ndarray, text: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each word that is looked up, for each of its places in the index: word, template, position there, start."""
        word = self.looked_up(codes, text, first)
        n = self.begin[codes[word] + 1] - self.begin[codes[word]]
        posting = np.repeat(self.begin[codes[word]], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        word = np.repeat(word, n)
        return word, self.template[posting], self.at[posting], word - self.at[posting]

    def phrases(self, codes: np.ndarray, text: np.ndarray, word: np.ndarray, template: np.ndarray, start: np.ndarray) -> list[tuple[int, int, int]]:
        """All places of the base phrases: template, text, start (as a word of all texts)."""
        out = []
        for k in range(self.n_base):
            want = self.codes[k]
            begin = np.unique(start[template == k])
            begin = begin[(begin >= 0) & (begin + len(want) <= len(codes))]
            begin = begin[(codes[begin[:, None] + np.arange(len(want))] == want).all(axis=1) & (text[begin] == text[begin + len(want) - 1])]
            out += [(k, int(text[b]), int(b)) for b in begin]
        return out

    def aligned(self, codes: np.ndarray, text: np.ndarray, word: np.ndarray, template: np.ndarray, at: np.ndarray, start: np.ndarray) -> list[tuple[int, int, float]]:
        """Verified alignments of the other templates, the longest at each place: template, text, share of the weight in place."""
        own = template >= self.n_base
        word, template, at, start = word[own], template[own], at[own], start[own]
        order = np.lexsort((start, template, text[word]))
        word, template, at, start = word[order], template[order], at[order], start[order]
        doc = text[word]
        new = np.ones(len(word), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (template[1:] != template[:-1]) | (start[1:] - start[:-1] > DRIFT)
        cluster = np.cumsum(new) - 1
        # each place of a template counts once
        distinct = np.unique(cluster * (1 << 20) + at, return_index=True)[1]
        votes = np.bincount(cluster[distinct], minlength=int(new.sum()))
        first, last = np.flatnonzero(new), np.append(np.flatnonzero(new)[1:], len(word)) - 1
        sizes = np.array([len(c) for c in self.codes])
        wanted = np.where(sizes < SHORT, 1, LEAST_VOTES)[template[first]] if len(first) else votes
        found: dict[int, list[tuple[int, int, int, float]]] = {}
        for c in np.flatnonzero(votes >= wanted).tolist():
            k, d = int(template[first[c]]), int(doc[first[c]])
            lo, hi = int(start[first[c]]), int(start[last[c]])
            if all(self._stands(codes, text, d, want, lo + offset - DRIFT, hi + offset + DRIFT) for offset, want in self.checks[k]) and (share := self._share(codes, text, d, k, lo, hi)) >= MIN_SHARE:
                found.setdefault(d, []).append((k, lo, lo + len(self.codes[k]), share))
        out = []
        for d, here in found.items():
            kept: list[tuple[int, int]] = []
            for k, a, b, share in sorted(here, key=lambda x: (x[1] - x[2], x[0])):
                if not any(min(b, y) - max(a, x) > (b - a) / 2 for x, y in kept):
                    out.append((k, d, share))
                kept.append((a, b))
        return out

    def _share(self, codes: np.ndarray, text: np.ndarray, doc: int, k: int, lo: int, hi: int) -> float:
        """Of a template's weight, the share of the words that stand where an alignment puts them, give or take DRIFT words."""
        want = self.codes[k]
        place = lo - DRIFT + np.arange(hi - lo + 2 * DRIFT + len(want))
        inside = (place >= 0) & (place < len(codes))
        near = np.where(inside, codes[np.clip(place, 0, len(codes) - 1)], -1)
        near[text[np.clip(place, 0, len(codes) - 1)] != doc] = -1
        stands = np.zeros(len(want), bool)
        for shift in range(hi - lo + 2 * DRIFT + 1):
            stands |= near[shift : shift + len(want)] == want
        return float(self.idf[want][stands].sum() / self.idf[want].sum())

    @staticmethod
    def _stands(codes: np.ndarray, text: np.ndarray, doc: int, phrase: np.ndarray, lo: int, hi: int) -> bool:
        """Whether a phrase begins at one of the words from lo to hi, within a text."""
        begin = np.arange(max(lo, 0), min(hi, len(codes) - len(phrase)) + 1)
        if not len(begin):
            return False
        begin = begin[(text[begin] == doc) & (text[begin + len(phrase) - 1] == doc)]
        return bool((codes[begin[:, None] + np.arange(len(phrase))] == phrase).all(axis=1).any())

    def scan(self, part: T.Slice) -> dict:
        starts, ends, text = part.spans(T.ALNUM)
        n_words = part.per_text(text)
        first = np.cumsum(n_words) - n_words
        places, base, all_, score = [[] for _ in range(part.n)], [set() for _ in range(part.n)], [set() for _ in range(part.n)], np.zeros(part.n)
        if len(text):
            codes = self.encode(part.hashes(starts, ends, T.BYTES_LOWER))
            word, template, at, start = self.votes(codes, text, first)
            for k, d, begin in self.phrases(codes, text, word, template, start):
                base[d].add(self.templates[k].label)
                all_[d].add(self.templates[k].label)
                places[d].append(begin - int(first[d]))
                score[d] = 1.0
            for k, d, share in self.aligned(codes, text, word, template, at, start):
                all_[d].add(self.templates[k].label)
                score[d] = max(score[d], share)
        joined = lambda sets: pa.array([",".join(sorted(s)) for s in sets], pa.string())
        whole = lambda values: pa.array(values, pa.int64())
        return {"n_words": n_words, "n_base": whole([len(p) for p in places]), "first_word": whole([min(p, default=None) for p in places]), "last_word": whole([max(p, default=None) for p in places]), "base_labels": joined(base), "labels": joined(all_), "score": score}


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """One row for each row of docs: doc_id and FOUND."""

    def make():
        index = Index(templates=templates)
        return lambda part, _: index.scan(part)

    return T.map_texts(docs, id_col, text_col, FOUND, make)
