"""Spelling variants of people's names: link the records of one person.

Merge-and-rematch resolution. Every record is parsed into a profile (possible
given names, initials, surnames, licences, specialties, institutions). Profiles
that share a blocking key become candidate pairs, every pair is scored once, and
sure matches are contracted to components: a component becomes one richer profile
with the union of its spellings and initials. Richer profiles enter blocking again
with the keys they have gained, until a round merges nothing. Then sparse profiles
(an initial, one surname) are attached to the one profile they fit best, if it is
the only best one, and the rounds go on.

Only ids and hashed keys are shuffled to find pairs, and only pairs with a changed
profile are scored again. Keys are specific (licence with initial, full name,
surname with given name and specialty or institution). The profiles of a key that
more than ``LARGE_KEY`` share are all compared as well, block against block, so
that no task holds more than two blocks. Surnames enter with their halves or
one-letter deletions, which makes misspellings meet. Nothing is collected on the
driver.

Defined results
---------------
* null or unparsable name: its own class; null licence, specialty or
  institution: unknown, compatible with everything.
* repeated rows of one id: one record. Ties in attaching: left unlinked.
* empty tables: no rows. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cordal.llm.lexicon import GIVEN_NAMES, NICKNAMES, bare
from cordal.session import bounded, checkpoint, ship

_GIVEN = {bare(g) for g in GIVEN_NAMES}
_SHORT: dict[str, set[str]] = {}
for _name, _forms in NICKNAMES.items():
    for _form in _forms.split():
        _SHORT.setdefault(bare(_form), set()).add(bare(_name))

#: What surrounds a name and is none.
_TITLE = re.compile(r"(?i)^(?:\s*(?:firmado|firma|fdo|prof(?:esor)?a?|dr\s*/\s*a|dra?|lic|m[eé]d)\b[.:]*\s*)+")
_SUFFIX = re.compile(r"\s*(?://.*|\([^)]*\)|\s-\s.*)$")
_OCR = str.maketrans("013458$", "oieasbs")
_PARTICLES = {"de", "del", "la", "las", "los", "da", "do", "dos"}

FIELDS = ["givens", "initials", "middles", "middle_initials", "either_initials", "first", "second", "second_initials", "licences", "specialties", "institutions"]
#: The profiles of a key that more share are compared block against block.
LARGE_KEY = 128
#: About so many profiles are in a block.
BLOCK = 2048
#: A worker hands on so many nodes with their keys at once.
NODES = 2000


def distance_one(a: str, b: str) -> bool:
    """Equal, or one insertion, deletion, substitution or swap of neighbours apart."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    if len(a) == len(b):
        return a[i + 1 :] == b[i + 1 :] or (a[i : i + 2] == b[i : i + 2][::-1] and a[i + 2 :] == b[i + 2 :])
    return a[i + 1 :] == b[i:] if len(a) > len(b) else a[i:] == b[i + 1 :]


def _skips(short: str, name: str) -> bool:
    """Whether ``short`` is made of letters of ``name`` in order, from its first on."""
    rest = iter(name)
    return short[:1] == name[:1] and all(c in rest for c in short)


def _fold(word: str) -> str:
    """Letters that readers and typists take for one another, as one."""
    return word.replace("rn", "m").replace("k", "qu")


@lru_cache(maxsize=20_000)
def given_candidates(token: str, dotted: bool = False) -> frozenset[str]:
    """Canonical given names a token may stand for (short form, prefix, one typo)."""
    if token in _GIVEN or token in _SHORT:
        exact = ({token} & _GIVEN) | _SHORT.get(token, set())
        return frozenset(exact | ({n for n in _GIVEN if n.startswith(token)} if dotted else set()))
    if dotted and len(token) > 1:
        return frozenset(n for n in _GIVEN if n.startswith(token)) or frozenset(n for n in _GIVEN if _skips(token, n))
    for ending in ("cito", "cita", "ito", "ita"):
        if token.endswith(ending) and len(token) > len(ending) + 2:
            stem = token[: -len(ending)]
            found = frozenset(n for n in _GIVEN if n == stem or n[:-1] == stem)
            if found:
                return found
    if len(token) > 3:
        return frozenset(n for n in _GIVEN if distance_one(token, n) or _fold(token) == _fold(n))
    return frozenset()


def _glued(token: str) -> tuple[str, str] | None:
    """A given name and a surname written as one word."""
    for name in sorted(_GIVEN, key=len, reverse=True):
        if token.startswith(name) and len(token) - len(name) >= 5 and len(name) > 3:
            return name, token[len(name) :]
    return None


def stated_specialty(name: str | None) -> str | None:
    """The specialty some writers put behind a name, in parentheses or after a dash."""
    found = re.search(r"\(([^()]+)\)\s*$|\s-\s+([^-]+)$", (name or "").strip())
    return (found.group(1) or found.group(2)).strip().lower() if found else None


def parse_name(name: str | None) -> dict[str, list[str]]:
    """The name part of a profile; empty lists where the name says nothing."""
    out: dict[str, set[str]] = {f: set() for f in FIELDS[:8]}
    text = _SUFFIX.sub("", _TITLE.sub("", (name or "").strip()))
    text = re.sub(r"(?<=[a-záéíóúñü])(?=[A-ZÁÉÍÓÚÑÜ])", " ", text)
    text = re.sub(r"(?<=[^\W\d_])[013458](?=[^\W\d_]|\b)|(?<![0-9])[013458](?=[^\W\d_])", lambda m: m.group().translate(_OCR), text)
    left, comma, right = text.partition(",")

    def tokens(part: str) -> list[tuple[str, bool]]:
        found = re.findall(r"([^\W\d_]+)(\.?)", part.replace("-", " ").replace("'", ""))
        return [(bare(w), dot == ".") for w, dot in found if bare(w) not in _PARTICLES]

    surnames: list[tuple[str, bool]]
    givens: list[tuple[str, bool]]
    if comma and tokens(right):
        surnames, givens = tokens(left), tokens(right)
    else:
        words = tokens(text)
        surnames, givens = [], []
        exact = lambda w: w[0] in _GIVEN or w[0] in _SHORT or (w[1] and len(w[0]) > 1 and bool(given_candidates(*w)))
        loose = lambda w: len(w[0]) > 3 and bool(given_candidates(*w))
        if not words:
            pass
        elif len(words[0][0]) == 1:
            n = 1
            while n < len(words) - 1 and len(words[n][0]) == 1:
                n += 1
            givens, surnames = words[:n], words[n:]
        elif exact(words[0]) or not exact(words[-1]) and loose(words[0]):
            n = 1
            while n < len(words) - 1 and (len(words[n][0]) == 1 or words[n][0] in _GIVEN):
                n += 1
            givens, surnames = words[:n], words[n:]
        elif exact(words[-1]) or loose(words[-1]):
            n = len(words) - 1
            while n > 1 and words[n - 1][0] in _GIVEN:
                n -= 1
            surnames, givens = words[:n], words[n:]
        elif len(words) > 1 and len(words[-1][0]) == 1:
            surnames, givens = words[:-1], words[-1:]
        elif cut := _glued(words[0][0]):
            givens, surnames = [(cut[0], False)], [(cut[1], False), *words[1:]]
        else:
            surnames = words
    if givens:
        word, dotted = givens[0]
        if len(word) == 1:
            out["initials"].add(word)
        else:
            found = given_candidates(word, dotted)
            out["givens"] |= found or {word}
            out["initials"] |= {n[0] for n in out["givens"]}
        for word, dotted in givens[1:]:
            if len(word) > 1:
                out["middles"] |= set(given_candidates(word, dotted)) or {word}
            elif len(givens[0][0]) == 1:
                out["middle_initials"].add(word)
            else:
                out["either_initials"].add(word)  # "Ana B. Castro": second given name or second surname
    if surnames:
        out["first"].add(surnames[0][0])
        if len(surnames) > 1:
            last = surnames[1][0]
            out["second_initials"].add(last[0])
            if len(last) > 1:
                out["second"].add(last)
    return {k: sorted(v) for k, v in out.items()}


def _near(a: set[str], b: set[str]) -> bool:
    return any(x == y or (min(len(x), len(y)) > 4 and (distance_one(x, y) or _fold(x) == _fold(y))) for x in a for y in b)


def surname_level(a: dict, b: dict) -> float:
    """0 conflict, 1 first surname, 1.5 and initial of the second, 2 both agree."""
    both = lambda p: {z for x in p["first"] for y in p["second"] for z in (x + y, y + x)}
    if a["second"] and b["second"]:
        if _near(both(a), both(b)) or _near(a["first"], b["first"]) and _near(a["second"], b["second"]):
            return 2
        if _near(a["first"], b["second"]) and _near(a["second"], b["first"]):
            return 2
        return 0
    if _near(both(a), b["first"]) or _near(a["first"], both(b)):
        return 2
    for p, q in ((a, b), (b, a)):
        if p["second"] and _near(p["second"], q["first"]) and q["second_initials"] & {x[0] for x in p["first"]}:
            return 1.5  # the surnames in the other order, one of them as an initial
        if any(x.startswith(y) and len(x) - len(y) > 3 and len(y) > 4 for x in p["first"] for y in q["first"]):
            return 1  # two surnames written as one word
    if not _near(a["first"], b["first"]):
        for p, q in ((a, b), (b, a)):
            if not p["second_initials"] and _near(p["first"], q["second"]):
                return 0.75  # only the second surname is written
        return 0
    seconds = a["second_initials"], b["second_initials"]
    if all(seconds):
        return 1.5 if seconds[0] & seconds[1] else 0
    return 1


def given_level(a: dict, b: dict) -> float:
    """0 conflict, 1 initials agree, 2 a full given name agrees."""
    if a["givens"] and b["givens"]:
        return 2 if a["givens"] & b["givens"] else 0
    return 1 if a["initials"] & b["initials"] or not (a["initials"] and b["initials"]) else 0


def middle_conflict(a: dict, b: dict) -> bool:
    if a["middles"] and b["middles"] and not a["middles"] & b["middles"]:
        return True
    for p, q in ((a, b), (b, a)):
        if p["middle_initials"] and q["middles"] and not p["middle_initials"] & {m[0] for m in q["middles"]}:
            return True
        if p["either_initials"] and q["second_initials"]:
            known = q["second_initials"] | {m[0] for m in q["middles"]} | q["middle_initials"]
            if not p["either_initials"] & known and (q["middles"] or q["middle_initials"]):
                return True
            if not p["either_initials"] & known and p["second_initials"]:
                return True
    return False


def licence_relation(a: set[str], b: set[str]) -> str:
    if not a or not b:
        return "unknown"
    if a & b:
        return "equal"
    return "near" if any(distance_one(x, y) for x in a for y in b) else "far"


def match_score(a: dict, b: dict) -> float:
    """0 for different people; 10 and more for a sure match; between, a weak one."""
    sur, given = surname_level(a, b), given_level(a, b)
    if not sur or not given or middle_conflict(a, b):
        return 0
    licence = licence_relation(a["licences"], b["licences"])
    special = bool(a["specialties"] & b["specialties"])
    if licence == "far" or (a["specialties"] and b["specialties"] and not special and licence != "equal"):
        return 0
    place = bool(a["institutions"] & b["institutions"])
    if licence == "equal":
        return 20
    either = a["either_initials"] & (b["second_initials"] | {m[0] for m in b["middles"]}) or b["either_initials"] & (
        a["second_initials"] | {m[0] for m in a["middles"]}
    )
    score = 2 * sur + 2 * given + (2 if special else 0) + (2 if place else 0) + (1 if licence == "near" else 0)
    score += 1 if either else 0
    if sur == 2 and given == 2 and (special or place or licence == "near"):
        return 10 + score
    if not (special or place or licence == "near"):
        # without field or place: given name and surname of the only candidate; a second name that agrees says more
        if given == 2 and (sur == 2 or either or a["middles"] & b["middles"]):
            return 0.1 * score
        return 0.05 * score if given == 2 and sur >= 1 else 0
    return min(score, 9.5)


def _union(a: dict, b: dict) -> dict:
    return {f: a[f] | b[f] for f in FIELDS} | {
        # possible readings of an abbreviation narrow to those both records allow
        "givens": (a["givens"] & b["givens"]) or a["givens"] | b["givens"],
    }


def _pack(profile: dict) -> str:
    """A profile as one string, equal for equal profiles."""
    return "\x1f".join("\x1e".join(sorted(x.translate(_NO_MARKS) for x in profile[f])) for f in FIELDS)


_NO_MARKS = {0x1E: " ", 0x1F: " "}


_NONE: frozenset = frozenset()


@lru_cache(maxsize=10_000)
def _unpack(text: str) -> dict:
    return {f: frozenset(x for x in part.split("\x1e") if x) if part else _NONE for f, part in zip(FIELDS, text.split("\x1f"))}


def _knowledge(p: dict) -> int:
    """How much a profile tells: sparse ones attach to richer ones, never the reverse."""
    return 2 * bool(p["second"]) + bool(p["second_initials"]) + 2 * bool(p["givens"]) + bool(p["middles"]) + bool(p["licences"]) + bool(p["specialties"])


def _deletions(words: set[str]) -> set[str]:
    """The words and all their one-letter deletions (words of five letters and more)."""
    return words | {w[:i] + w[i + 1 :] for w in words if len(w) > 4 for i in range(len(w))}


def _alike(words: set[str]) -> set[str]:
    """Keys of which words one edit apart share at least one.

    Long words are cut in halves: an edit leaves one of them whole. Both cuts that
    a word one letter longer or shorter may have are kept. Short halves would meet
    too many words, so short words have their one-letter deletions.
    """
    short = {w for w in words if len(w) <= _CUT}
    cuts = {(w, n) for w in words if len(w) >= _CUT for n in ((len(w) - 1) // 2, len(w) // 2)}
    return _deletions(short) | {w[:n] + "<" for w, n in cuts} | {">" + w[-n:] for w, n in cuts}


_CUT = 7


def blocking_keys(p: dict, stage: str) -> set[str]:
    """Keys under which a profile meets others in a stage ("sure" or "sparse")."""
    joined = {z for x in p["first"] for y in p["second"] for z in (x + y, y + x)}
    whole = joined | {x for x in p["first"] if len(x) > 9}
    initials = p["initials"] | {g[0] for g in p["givens"]}
    surnames = p["first"] | p["second"]
    alike = _alike(surnames | {_fold(x) for x in surnames})
    if stage == "sure":
        return (
            {f"l|{i}|{n}" for i in initials for n in p["licences"]}
            | {f"n|{w}|{g}" for w in _alike(whole) for g in p["givens"]}
            | {f"p|{x}|{g}|{e}" for x in alike for g in p["givens"] for e in p["specialties"]}
        )
    if not p["second"]:  # perhaps two surnames in one word: its beginnings may be known alone
        alike |= _alike({x[:n] for x in p["first"] if len(x) > 11 for n in range(5, len(x) - 3)})
    return (
        {f"s|{x}|{i}|{e}" for x in alike for i in initials for e in p["specialties"]}
        | {f"i|{x}|{i}|{e}" for x in alike for i in initials for e in p["institutions"]}
        | {f"g|{w}|{g}" for w in _alike(whole) for g in p["givens"]}
        | {f"k|{x}|{i}|{n}" for x in surnames for i in initials for n in _deletions(p["licences"])}
        | {f"b|{x}|{g}" for x in p["first"] for g in p["givens"]}
    )


def _bits(words: set[str]) -> int:
    """One of 64 bits for each word; sets without a common bit have no common word."""
    return reduce(lambda m, w: m | 1 << (hash(w) & 63), words, 0)


def _ends(words: set[str]) -> int:
    """Bits of the first two and the last two characters, of which words that ``_near`` takes for one share at least one."""
    return _bits({e for w in words for x in (w, _fold(w)) for e in (x[:2] + "<", ">" + x[-2:])})


_ALL = (1 << 64) - 1


def _traits(p: dict) -> tuple[int, ...]:
    """What ``_possible`` tests of a profile, as bits."""
    number = _ALL if any(len(n) < 5 for n in p["licences"]) else _ends(p["licences"])
    one = len(p["first"]) < 2 and len(p["second"]) < 2
    letters = {c for w in p["first"] | p["second"] for c in w if c not in "rnmkqu"}  # _fold changes the others nowhere
    return (
        _bits(p["specialties"]), _bits(p["licences"]), number, _bits(p["givens"]), _bits(p["initials"]),
        _ends(p["second"]), _ends(p["first"]), reduce(lambda m, c: m | 1 << (ord(c) & 63), letters, 0), int(one),
    )


def _possible(one: np.ndarray, many: np.ndarray, stage: str) -> np.ndarray:
    """Which profiles may match one; ``match_score`` is 0 (in the stage "sure" below 10) for all others.

    Each test follows from a rule of ``match_score``: fields, given names, licences
    or second surnames that exclude each other.
    """
    field, licence, number, given, initial, second, first, letters, single = many
    f, n, m, g, i, s, x, z, u = one
    equal = licence & n != 0
    ok = equal | (field == 0) | (f == 0) | (field & f != 0)
    ok &= (licence == 0) | (n == 0) | (number & m != 0)
    named, both = (given != 0) & (g != 0), (second != 0) & (s != 0)
    ok &= np.where(named, given & g != 0, (initial == 0) | (i == 0) | (initial & i != 0))
    spelt = (single & u == 0) | (np.bitwise_count(letters ^ z) <= 2)
    ok &= ~both | spelt | (second & (s | x) != 0) | (first & s != 0)
    if stage == "sure":
        ok &= equal | named & (both | ((second != 0) | (s != 0)) & spelt)
    return ok


def _hash(key: str) -> int:
    """A signed 64-bit hash, equal in every process."""
    import xxhash

    value = xxhash.xxh64_intdigest(key)
    return value - (1 << 64) if value >> 63 else value


def _row(pid: int, profile: dict, moment: int) -> tuple:
    return pid, _pack(profile), *[sorted(_hash(k) for k in blocking_keys(profile, s)) for s in ("sure", "sparse")], moment


NODE = "pid bigint, perfil string, sure array<bigint>, sparse array<bigint>, desde int"
_NODE_COLUMNS = [c.split()[0] for c in NODE.split(", ")]


def profiles(records: DataFrame) -> DataFrame:
    """(id, perfil): one packed profile per id of (id, nombre, matricula, especialidad, institucion)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            packed = []
            for name, *rest in zip(batch["nombre"], *[batch[f] for f in FIELDS[8:]]):
                p = {k: set(v) for k, v in parse_name(name).items()} | {f: set(x) for f, x in zip(FIELDS[8:], rest)}
                if stated := stated_specialty(name):
                    p["specialties"].add(stated)
                packed.append(_pack(p))
            yield pd.DataFrame({"id": batch["id"], "perfil": packed})

    digits = F.ltrim(F.regexp_replace("matricula", "[^0-9]", ""), F.lit("0"))
    one = lambda c: F.when(c.isNotNull() & (c != ""), F.array(c)).otherwise(F.array().cast("array<string>"))
    rows = (
        records.where(F.col("id").isNotNull())
        .groupBy(F.col("id").cast("string").alias("id"))
        .agg(
            F.min("nombre").alias("nombre"),
            F.array_distinct(F.flatten(F.collect_set(one(digits)))).alias("licences"),
            F.array_distinct(F.flatten(F.collect_set(one(F.lower("especialidad"))))).alias("specialties"),
            F.array_distinct(F.flatten(F.collect_set(one(F.lower("institucion"))))).alias("institutions"),
        )
    )
    return rows.mapInPandas(run, "id string, perfil string")


def _nodes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Nodes of packed profiles, with the hashes of their keys of both stages."""
    for batch in batches:
        for n in range(0, len(batch), NODES):
            part = batch.iloc[n : n + NODES]
            yield pd.DataFrame([_row(pid, _unpack(t), 0) for pid, t in zip(part["pid"], part["perfil"])], columns=_NODE_COLUMNS)


def _matches(nodes: DataFrame, stage: str, since: int, limit: int) -> DataFrame:
    """The matches among all pairs that share a key, one of them newer than round ``since``, as ``_match`` gives them.

    Only ids and hashed keys are shuffled. Keys of one profile, or of old ones
    alone, are dropped before that. The pairs of a key with more than ``limit``
    profiles are never written down: ``_crowded`` compares them.
    """
    keyed = nodes.select("pid", (F.col("desde") > since).alias("nuevo"), F.explode(stage).alias("clave"))
    if since >= 0:
        fresh = checkpoint(keyed.where("nuevo").select("clave").distinct())
        keyed = keyed.join(bounded(fresh), "clave", "left_semi")
    sizes = keyed.groupBy("clave").agg(F.count("*").alias("n"), F.max("nuevo").alias("alguno")).where("n > 1 AND alguno")
    shared = checkpoint(sizes)
    large = shared.where(F.col("n") > limit).select("clave", "n")
    rows = keyed.join(shared.where(F.col("n") <= limit).select("clave"), "clave")
    left, right = rows.select("clave", F.col("pid").alias("a"), "nuevo"), rows.select("clave", F.col("pid").alias("b"), F.col("nuevo").alias("_n"))
    pairs = left.join(right, "clave").where("a < b AND (nuevo OR _n)").select("a", "b").distinct()
    found = _scored(nodes, pairs, stage)
    return found if large.isEmpty() else found.union(_crowded(nodes, keyed.join(large, "clave"), stage)).distinct()


MATCH = "a bigint, b bigint, puntos double, saber int"
_MATCH_COLUMNS = [c.split()[0] for c in MATCH.split(", ")]


def _match(a: int, b: int, p: dict, q: dict, stage: str) -> tuple | None:
    """(a, b, puntos, saber) of a pair that matches: ``a`` tells less, ``saber`` is how much ``b`` tells."""
    score = match_score(p, q)
    if score <= 0 or stage == "sure" and score < 10:
        return None
    m, n = _knowledge(p), _knowledge(q)
    return (a, b, score, n) if (-m, a) > (-n, b) else (b, a, score, m)


def _scored(nodes: DataFrame, pairs: DataFrame, stage: str) -> DataFrame:
    """The matches among the pairs (a, b)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = (_match(a, b, _unpack(x), _unpack(y), stage) for a, b, x, y in zip(batch["a"], batch["b"], batch["x"], batch["y"]))
            yield pd.DataFrame([m for m in found if m], columns=_MATCH_COLUMNS)

    both = pairs.join(nodes.select(F.col("pid").alias("a"), F.col("perfil").alias("x")), "a")
    both = both.join(nodes.select(F.col("pid").alias("b"), F.col("perfil").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInPandas(run, MATCH)


def _crowded(nodes: DataFrame, keyed: DataFrame, stage: str) -> DataFrame:
    """The matches among all pairs of each key of (pid, nuevo, clave, n), one of the two new.

    A key's profiles are dealt into blocks, and every two blocks (and every block
    with itself) meet in one cell. A pair with several of these keys is scored
    under the smallest only.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cell, rows = None, []
        for batch in batches:
            columns = [batch[c] for c in ("clave", "i", "j", "bloque", "pid", "nuevo", "perfil", "claves")]
            for clave, i, j, *row in zip(*columns):
                if (clave, i, j) != cell:
                    yield from _cell(cell, rows, stage)
                    cell, rows = (clave, i, j), []
                rows.append(row)
        yield from _cell(cell, rows, stage)

    owners = keyed.groupBy("pid").agg(F.collect_set("clave").alias("claves")).join(nodes.select("pid", "perfil"), "pid")
    parts = F.ceil(F.col("n") / BLOCK)
    dealt = keyed.join(owners, "pid").withColumn("bloque", F.pmod(F.xxhash64("pid"), parts))
    dealt = dealt.withColumn("otro", F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1)))
    dealt = dealt.select("clave", F.least("bloque", "otro").alias("i"), F.greatest("bloque", "otro").alias("j"), "bloque", "pid", "nuevo", "perfil", "claves")
    tasks = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(tasks, "clave", "i", "j").sortWithinPartitions("clave", "i", "j").mapInPandas(run, MATCH)


def _cell(cell: tuple | None, rows: list, stage: str) -> Iterator[pd.DataFrame]:
    """The matches of a cell's rows (bloque, pid, nuevo, perfil, claves): between its two blocks, or within its one."""
    if not rows:
        return
    clave, i, j = cell
    right = [r for r in rows if r[0] == j]
    pids, news = np.array([r[1] for r in right], "int64"), np.array([r[2] for r in right], bool)
    traits = np.array([_traits(_unpack(r[3])) for r in right], "uint64").reshape(-1, 9).T
    keys, out = [frozenset(r[4].tolist()) for r in right], []
    for _, a, new, text, own in rows if i == j else (r for r in rows if r[0] == i):
        p, own = _unpack(text), frozenset(own.tolist())
        ok = _possible(np.array(_traits(p), "uint64"), traits, stage)
        if i == j:
            ok &= pids > a
        if not new:
            ok &= news
        for k in np.flatnonzero(ok):
            if min(keys[k] & own) == clave:
                m = _match(a, int(pids[k]), p, _unpack(right[k][3]), stage)
                if m:
                    out.append(m)
        if len(out) > 20_000:
            yield pd.DataFrame(out, columns=_MATCH_COLUMNS)
            out = []
    yield pd.DataFrame(out, columns=_MATCH_COLUMNS)


def _single_best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The link (a, b) of every profile with one best partner, from a stream sorted by it, the best partners first.

    Partners that may be one person themselves count as one: the richest of the
    best stands for all. Partners that exclude each other stay rivals; only a
    lead of a whole point decides between them.
    """
    name, partner, best, profile, alone, out = None, None, 0.0, None, False, []
    for batch in batches:
        for a, b, score, text in zip(batch["a"], batch["b"], batch["puntos"], batch["perfil"]):
            if a != name:
                if alone:
                    out.append((name, partner))
                name, partner, best, profile, alone = a, b, score, _unpack(text), True
            elif alone and best - score < 1 and not match_score(_unpack(text), profile) > 0:
                alone = False
        yield pd.DataFrame(out, columns=["a", "b"])
        out = []
    if alone:
        yield pd.DataFrame([(name, partner)], columns=["a", "b"])


def _merge_nodes(moment: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """One node per class from a stream sorted by class."""
        name, merged, out = None, None, []
        for batch in batches:
            for clase, text in zip(batch["clase"], batch["perfil"]):
                if clase == name:
                    merged = _union(merged, _unpack(text))
                else:
                    if name is not None:
                        out.append(_row(name, merged, moment))
                    name, merged = clase, _unpack(text)
                    if len(out) == NODES:
                        yield pd.DataFrame(out, columns=_NODE_COLUMNS)
                        out = []
            yield pd.DataFrame(out, columns=_NODE_COLUMNS)
            out = []
        if name is not None:
            yield pd.DataFrame([_row(name, merged, moment)], columns=_NODE_COLUMNS)

    return run


def components(links: DataFrame) -> DataFrame:
    """(pid, clase) of every linked pid: the smallest id it reaches over any number of links.

    A turn takes a hop to the neighbours, a pointer jump (the class of one's own
    class) and a hop; jumps double the reach, so long chains need few turns. A
    turn whose last hop changed nothing is the last.
    """
    both = checkpoint(links.select("a", "b").union(links.select("b", "a")).distinct())
    labels = both.groupBy(F.col("a").alias("pid")).agg(F.least(F.col("pid"), F.min("b")).alias("clase"))

    def hop(labels: DataFrame) -> DataFrame:
        offered = both.join(labels.withColumnRenamed("pid", "b"), "b").groupBy("a").agg(F.min("clase").alias("oferta"))
        joined = labels.join(offered, labels["pid"] == offered["a"])
        return joined.select("pid", F.least("clase", "oferta").alias("clase"), (F.col("oferta") < F.col("clase")).alias("cambio"))

    def jump(labels: DataFrame) -> DataFrame:
        further = labels.select(F.col("pid").alias("clase"), F.col("clase").alias("lejos"))
        return labels.join(further, "clase").select("pid", F.least("clase", "lejos").alias("clase"))

    while True:
        turn = checkpoint(hop(jump(hop(labels).drop("cambio"))))
        labels = turn.drop("cambio")
        if turn.where("cambio").isEmpty():
            return labels


def same_person(records: DataFrame, limit: int = LARGE_KEY) -> DataFrame:
    """(id, persona) for records of (id, nombre, matricula, especialidad, institucion).

    Sure matches merge until there are none; then sparse profiles are attached,
    and both take turns until neither merges anything. In every round only pairs
    with a profile that has changed since the stage last ran are compared; scores
    of the sparse stage are kept for the others.
    """
    ship(records.sparkSession)
    named = checkpoint(profiles(records).orderBy("id").withColumn("pid", F.monotonically_increasing_id()))
    nodes = checkpoint(named.select("pid", "perfil").mapInPandas(_nodes, NODE))
    members = named.select("id", F.col("pid").alias("actual"))
    last, known, moment, quiet, stage = {"sure": -1, "sparse": -1}, None, 0, 0, "sure"
    while quiet < 2:
        scored = _matches(nodes, stage, last[stage], limit)
        last[stage] = moment
        if stage == "sure":
            links = checkpoint(scored.select("a", "b"))
        else:
            known = checkpoint(scored if known is None else known.union(scored))
            best = known.groupBy("a").agg(F.max("puntos").alias("mejor"))
            close = known.join(best, "a").where("puntos >= mejor - 1").join(nodes.select(F.col("pid").alias("b"), "perfil"), "b")
            ordered = close.select("a", "b", "puntos", "saber", "perfil").repartition("a").sortWithinPartitions("a", F.desc("puntos"), F.desc("saber"), "b")
            links = checkpoint(ordered.mapInPandas(_single_best, "a bigint, b bigint"))
        if links.isEmpty():
            quiet += 1
            stage = "sparse" if stage == "sure" else "sure"
            continue
        quiet, moment = 0, moment + 1
        classes = components(links)
        linked = nodes.join(classes, "pid").select("clase", "perfil").repartition("clase").sortWithinPartitions("clase", "perfil")
        merged = linked.mapInPandas(_merge_nodes(moment), NODE)
        nodes = checkpoint(nodes.join(classes, "pid", "left_anti").select(*_NODE_COLUMNS).union(merged))
        if known is not None:
            gone = classes.select("pid")
            known = known.join(gone, known["a"] == gone["pid"], "left_anti").join(gone, known["b"] == gone["pid"], "left_anti")
        moved = classes.withColumnsRenamed({"pid": "actual", "clase": "nueva"})
        members = members.join(moved, "actual", "left").select("id", F.coalesce("nueva", "actual").alias("actual"))
        stage = "sure"
    heads = named.select(F.col("pid").alias("actual"), F.col("id").alias("persona"))
    return members.join(heads, "actual").select("id", "persona")


def physician_classes(signatures: DataFrame) -> DataFrame:
    """(id, persona) of the spellings in ``firma_medico``."""
    return same_person(
        signatures.select(F.col("id_medico").alias("id"), "nombre", "matricula", "especialidad", "institucion")
    )


def linked_pairs(classes: DataFrame) -> DataFrame:
    """Every pair of ids of one person, the smaller first."""
    other = classes.select(F.col("id").alias("id_2"), "persona")
    return (
        classes.join(other, "persona")
        .where(F.col("id") < F.col("id_2"))
        .select(F.col("id").alias("id_medico_a"), F.col("id_2").alias("id_medico_b"))
    )
