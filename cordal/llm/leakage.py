"""Held-out test items that turn up, whole or in part, in a training corpus.

Every item is normalised to words; its runs of three words (and whole items
that are shorter) and its whole answer are the patterns of one Aho-Corasick
automaton. A document is
normalised the same way, with the offset of every word in the original kept,
and scanned once. The hits of an item are chained into stretches (increasing in
document and item, gaps of a few edited words allowed); an item is reported when
its best one or two disjoint stretches hold enough of its words. The test for
"enough" first counts covered words exactly, so chaining runs on few pairs.
An answer alone is no leak (it may be one letter); of a leaked item it is
reported where it follows the question.

Documents are only read and mapped: no shuffle, no cap on hits. The items are a
held-out set; they go to the executors in blocks of at most ``BLOCK_BYTES``, so
the size of a broadcast is bounded whatever the number and length of the items.
A Python worker builds the automaton of a block once, not once per task.

Defined results
---------------
* null or empty text or item: never a hit. Items under three words must occur whole.
* items without an answer: the columns of the answer are null.
* repeated documents: each doc_id is reported; repeated rows of one doc_id once.
* very long texts are scanned whole.
"""

from __future__ import annotations

import re
import unicodedata
import uuid
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cordal.session import ship

RUN_WORDS = 3
GAP_WORDS = 10
SHARE = 0.5
BLOCK_BYTES = 16 << 20
ANSWER_WORDS = 12  # an answer is looked for so many words behind the question

_WORD = re.compile(r"\w+(?:[-­][ \t]*\r?\n[ \t]*\w+|­\w+)*")
_NOT_WORD = re.compile(r"[\W_]+")

SCHEMA = "doc_id bigint, item_id bigint, fraccion double, inicio int, fin int, inicio_2 int, fin_2 int, respuesta_inicio int, respuesta_fin int"


def words(text: str) -> tuple[list[str], list[tuple[int, int]]]:
    """Normalised words (lower case, no accents, joined at line ends) and their offsets."""
    found, spans = [], []
    for m in _WORD.finditer(text):
        word = m.group().lower()
        if not word.isascii():
            word = "".join(c for c in unicodedata.normalize("NFKD", word) if not unicodedata.combining(c))
        if not word.isalnum():
            word = _NOT_WORD.sub("", word)
        if word:
            found.append(word)
            spans.append(m.span())
    return found, spans


def _chain(seeds: list[tuple[int, int]], run: int) -> tuple[int, list[tuple[int, int]]]:
    """Matched words and seeds of the best chain of sorted (document, item) seeds."""
    score, back = [run] * len(seeds), [-1] * len(seeds)
    for b, (doc_b, item_b) in enumerate(seeds):
        for a in range(b - 1, -1, -1):
            doc_a, item_a = seeds[a]
            if doc_b - doc_a > GAP_WORDS:
                break
            step = min(doc_b - doc_a, item_b - item_a)
            if 0 < step and item_b - item_a <= GAP_WORDS and score[a] + min(run, step) > score[b]:
                score[b], back[b] = score[a] + min(run, step), a
    at = max(range(len(seeds)), key=score.__getitem__)
    total, path = score[at], []
    while at >= 0:
        path.append(seeds[at])
        at = back[at]
    return total, path[::-1]


def best_stretches(seeds: list[tuple[int, int]], run: int) -> list[tuple[int, int, int]]:
    """Up to two disjoint stretches: (matched words, first word, last word in the document)."""
    out, rest = [], sorted(set(seeds))
    while rest and len(out) < 2:
        total, path = _chain(rest, run)
        (d0, i0), (d1, i1) = path[0], (path[-1][0] + run, path[-1][1] + run)
        out.append((total, d0, d1 - 1))
        rest = [(d, i) for d, i in rest if (d >= d1 or d + run <= d0) and (i >= i1 or i + run <= i0)]
    return out


class Scanner:
    """One automaton over the word runs and the answers of all items of a block."""

    def __init__(self, items: list[tuple]):
        import ahocorasick

        self.size: dict[int, int] = {}
        self.answer: dict[int, tuple[str, str]] = {}
        posts: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for item, text, *answer in items:
            tokens = words(text)[0]
            run = min(RUN_WORDS, len(tokens))
            self.size[item] = len(tokens)
            for i in range(len(tokens) - run + 1 if run else 0):
                posts[" " + " ".join(tokens[i : i + run]) + " "].append((item, i))
            if answer and (tokens := words(answer[0] or "")[0]):
                self.answer[item] = " " + " ".join(tokens) + " ", answer[0].strip()
        for pattern, _ in self.answer.values():
            posts.setdefault(pattern, [])
        answers = {pattern for pattern, _ in self.answer.values()}
        self.automaton = ahocorasick.Automaton()
        for pattern, where in posts.items():
            self.automaton.add_word(pattern, (pattern.count(" ") - 1, where, pattern if pattern in answers else None))
        if posts:
            self.automaton.make_automaton()
        self.any = bool(posts)

    def scan(self, text: str) -> Iterator[tuple[int, float, list[int]]]:
        """(item, share of its words, offsets of its stretches) of the leaked items."""
        tokens, spans = words(text)
        if not tokens or not self.any:
            return
        line = " " + " ".join(tokens) + " "
        starts = [0] * (len(line) + 1)  # word index by its end in the line
        at = 0
        for n, token in enumerate(tokens):
            at += len(token) + 1
            starts[at] = n
        hits: dict[int, list[tuple[int, int]]] = defaultdict(list)
        answers: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for end, (run, where, answer) in self.automaton.iter(line):
            first = starts[end] - run + 1
            if answer is not None:
                answers[answer].append((first, first + run - 1))
            for item, i in where:
                hits[item].append((first, i))
        for item, seeds in hits.items():
            size = self.size[item]
            run = min(RUN_WORDS, size)
            if len({i + k for _, i in seeds for k in range(run)}) < SHARE * size:
                continue
            stretches = best_stretches(seeds, run)
            share = sum(s[0] for s in stretches) / size
            if share >= SHARE:
                cut = [x for _, a, b in stretches for x in (spans[a][0], spans[b][1])]
                yield item, min(share, 1.0), (cut + [None, None])[:4] + self._answer(item, text, spans, answers, max(b for _, _, b in stretches))

    def _answer(self, item: int, text: str, spans: list, answers: dict, last: int) -> list[int | None]:
        """Offsets of the item's answer behind the word ``last``; one letter has to be written as in the item."""
        pattern, written = self.answer.get(item, ("", ""))
        for a, b in answers.get(pattern, ()):
            found = text[spans[a][0] : spans[b][1]]
            if last < a <= last + ANSWER_WORDS and (len(written) > 1 or found == written):
                return [spans[a][0], spans[b][1]]
        return [None, None]


_SCANNERS: dict[str, Scanner] = {}


def _scanner(token: str, items: list[tuple]) -> Scanner:
    """The scanner of a block, built once per Python worker; older ones make room."""
    if token not in _SCANNERS:
        if len(_SCANNERS) > 3:
            _SCANNERS.clear()
        _SCANNERS[token] = Scanner(items)
    return _SCANNERS[token]


def leaked_items(documents: DataFrame, items: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, item_id, fraccion, the character offsets of up to two stretches and of the answer.

    ``documents`` has doc_id and text, ``items`` has item_id, texto and perhaps respuesta.
    """
    spark = documents.sparkSession
    ship(spark)
    answer = F.col("respuesta").cast("string") if "respuesta" in items.columns else F.lit(None).cast("string")
    listed = items.where(F.col("texto").isNotNull()).select(F.col("item_id").cast("long"), "texto", answer.alias("respuesta")).distinct()
    size = listed.agg(F.sum(F.octet_length("texto") + F.coalesce(F.octet_length("respuesta"), F.lit(0)))).first()[0] or 0
    blocks = -(-size // block_bytes) or 1
    source = documents.where(F.col("text").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def search(part: int) -> DataFrame:
        chosen = listed if blocks == 1 else listed.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == part)
        shared = spark.sparkContext.broadcast([tuple(r) for r in chosen.collect()])  # one bounded block of items
        token = uuid.uuid4().hex

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            scanner = _scanner(token, shared.value)
            for batch in batches:
                rows = []
                for doc, text in zip(batch["doc_id"], batch["text"]):
                    for item, share, cut in scanner.scan(text):
                        rows.append((doc, item, share, *cut))
                out = pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")])
                yield out.astype({c: "Int32" for c in out.columns[5:]})

        return source.mapInPandas(run, SCHEMA)

    return reduce(DataFrame.unionByName, [search(p) for p in range(blocks)]).dropDuplicates(["doc_id", "item_id"])
