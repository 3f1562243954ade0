"""Personal information in free text: found by a semi-Markov conditional random field, replaced by typed placeholders.

Candidate segments are proposed by shape alone, with several boundaries for one place: a run of digit groups also without its first or last groups, an
address also without its last parts, neighbouring pairs of words that may be a name and longer spans around them (a middle word, particles).
The model scores whole candidates: their digits, grouping and separators, whether more of the same stands just outside, the words around them, street
and house parts, the roles of the words of a name. Dynamic programming over the candidates' boundaries, each at most MOST_CHARS long, chooses
boundaries and types together: the best set of segments that don't overlap; text outside segments scores 0. Training maximises
the likelihood of labelled sentences (pii_training) with the forward and backward sums of the same lattice.

Name roles come from a list of given and family names, widened by words that stand beside listed names in the author field:
`induced_names` keeps those seen with at least two different listed names and in at least 3 rows, however many rows there are. All of them
are sent to the executors, so their memory grows with the number of different names.

Texts are scanned for triggers first; the lattice is built only around them, as nothing else can hold a candidate.

Defined results: null and blank values hold nothing and stay as they are; texts of any length are read whole; repeated rows get equal
results; an empty name list leaves roles to the induced names; empty tables give no rows.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.pii_training import TYPES, sentences

MOST_CHARS = 160
PLACEHOLDERS = {"email": "[EMAIL]", "phone": "[PHONE]", "id_number": "[ID_NUMBER]", "address": "[ADDRESS]", "name": "[NAME]"}

_MAIL = re.compile(r"[^\W_][\w.+\-]*\s?(?:@|\(at\)|\[at\])\s?[^\W_][\w\-]*(?:(?:\.|\s(?:dot|titik|punto|point)\s|\s?[(\[]dot[)\]]\s?)[\w\-]+)*", re.I)
_NUMBER = re.compile(r"(?<![\w.,/$€-])(?:[XYZ]\d|\(\+?\d{1,4}\)\s?\d|\+?\d)(?:[\d()]|[ .\-/]{1,2}(?=[\d(]))*\d(?:-?[A-Z])?(?![\w]|[.,]\d)")
_NO = r"(?:(?:n(?:o|omor|ro|úm|um|º|°)|kav(?:ling)?)\b\.?\s*|n[º°]\s*)?"
#: A mail address that is spelt out whole.
_SPELT = re.compile(r"\b[^\W_]+(?:\s(?:dot|titik|punto|point)\s[^\W_]+)*\s(?:at|arroba|arobase)\s[^\W_]+(?:\s(?:dot|titik|punto|point)\s[^\W_]{2,})+", re.I)
_STREET = [
    re.compile(r"\b(?P<cue>jl|jln|jalan|gang|gg|dusun|kampung|kp)\b\.?\s+(?:[^\W\d_][\w'’\-]*\s+){1,5}?(?:blok\s*\w{1,4}\s+)?" + _NO + r"\d{1,4}[a-z]?\b(?:\s*,?\s*(?:rt|rw)\b\.?\s*\d{1,3}(?:\s*/\s*(?:rw\s*)?\d{1,3})?)*(?:\s*,?\s*no(?:mor)?\b\.?\s*\d{1,4})?", re.I),
    re.compile(r"(?<![\w.,$€£:])(?:(?:flat|apt|unit|suite)\.?\s*\d+\w?,?\s*)?\d{1,4}[a-z]?\s+(?:[^\W\d_][\w'’\-]*\s+){1,4}?(?P<cue>street|lane|road|avenue|drive|close|court|ave|rd|st|ln)\b", re.I),
    re.compile(r"(?:\b(?P<cue>calle|avenida|avda|plaza|paseo|av)\b\.?|\bc/)\s*(?:[^\W\d_][\w'’\-]*,?\s+){1,5}?" + _NO + r"\d{1,4}\b(?:\s*,\s*\d{1,2}\s?º(?:\s?[a-z]\b)?)?", re.I),
    re.compile(r"(?<![\w.,$€:])\d{1,4}(?:\s?(?:bis|ter)\b)?,?\s+(?P<cue>rue|avenue|boulevard|impasse|allée|chemin|place)\s+(?:(?:d[eu]s?|la|le|les|l['’])\s*)*[^\W\d_][\w'’\-]*(?:\s+(?-i:[A-ZÀ-Ý])[\w'’\-]*)*", re.I),
]
_PAIR = re.compile(r"(?<![\w@.])([^\W\d_]{2,}(?:['’\-][^\W\d_]+)*)(,?)[ \t ]+(?=([^\W\d_]{2,}(?:['’\-][^\W\d_]+)*)(?![\w@]))")
_LONGER = re.compile(r"(?<![\w@.])([^\W\d_]{2,}(?:['’\-][^\W\d_]+)*)((?:[ \t ]+(?:van|der|den|de|del|della|di|da|dos|bin|binti|al|el|la|von|ter)){1,3}|[ \t ]+[^\W\d_]{1,}\.?)[ \t ]+(?=([^\W\d_]{2,}(?:['’\-][^\W\d_]+)*)(?![\w@]))")
_GROUP = re.compile(r"[+(]?\(?\d+\)?(?:-?[A-Z]\b)?")
_WORDS = re.compile(r"[^\W_]+|[@:/$€#]")
_DIGIT_RUN = re.compile(r"\d[\d .\-/()]{5,}[\d]")

_SMALL = {"de", "del", "de la", "la", "las", "los", "el", "du", "des", "le", "les", "rue", "avenue", "calle", "avenida", "boulevard", "bis", "ter", "no", "rt", "rw", "blok", "nomor", "núm", "flat", "jl", "jln", "jalan", "gang", "gg"}
#: Words that may open an address; a name may follow the second list even if neither of its words has a known role.
STREET_CUES = ("jl", "jln", "jalan", "gang", "gg", "dusun", "kampung", "kp", "street", "lane", "road", "avenue", "drive", "court", "close", "ave", "rd", "st", "ln", "calle", "avenida", "avda", "av", "c/", "plaza", "paseo", "rue", "boulevard", "impasse", "allée", "chemin", "place")
NAME_CUES = ("penulis", "laporan", "atas nama", "account of", "held by", "au nom de", "a nombre de", "texte de", "texto de", "name is", "nama saya", "me llamo", "m'appelle", "reporter", "reportera", "reportero", "jurnalis", "journalist", "dr", "mr", "mrs", "ms", "mme", "señor", "señora", "monsieur", "madame")


_PARTICLES = re.compile(r"(?:(?:van|der|den|de|del|della|di|da|dos|bin|binti|al|el|la|von|ter)\s*)+")


def _boundaries(m: re.Match) -> list[tuple[int, int, str]]:
    """(start, end, on which side more groups follow): a run of digit groups, and the same without up to two groups at either end."""
    out = [(m.start(), m.end(), "")]
    groups = [(m.start() + g.start(), m.start() + g.end()) for g in _GROUP.finditer(m.group())]
    for k in (1, 2):
        if len(groups) > k:
            out += [(groups[k][0], m.end(), "left"), (m.start(), groups[-1 - k][1], "right")]
    return out


def _shape(word: str) -> str:
    return "U" if word.isupper() and len(word) > 1 else ("T" if word[:1].isupper() else "l")


@dataclass
class Segmenter:
    roles: dict[str, str]  # lower-case word -> g, f or b (both)
    weights: dict[str, float] = field(default_factory=dict)

    def candidates(self, text: str, cued: bool = True) -> list[tuple[int, int, str, list[str]]]:
        """(start, end, type, features), sorted by end. A number is proposed once for each type that it may be."""
        out = []
        low = text.lower()

        def around(a: int, b: int) -> tuple[list[str], str]:
            before = _WORDS.findall(low[max(0, a - 48) : a])[-3:]
            after = _WORDS.findall(low[b : b + 24])[:1]
            return before, (after[0] if after else "$")

        for m in _MAIL.finditer(text):
            out.append((m.start(), m.end(), "email", ["bias:e", "at:" + ("@" if "@" in m.group() else "spelt"), "dots:" + str(min(2, len(re.findall(r"\.|dot", m.group().lower().split("@")[-1].split("at", 1)[-1]))))]))
        if " at " in low or " arroba " in low or " arobase " in low:
            for m in _SPELT.finditer(text):
                last = m.group().lower().split()[-1]
                out.append((m.start(), m.end(), "email", ["bias:e", "at:word", f"top:{last if last in ('com', 'org', 'net', 'id', 'es', 'fr', 'test', 'example', 'invalid') else 'other'}"]))
        for m in _NUMBER.finditer(text):
            for start, end, more in _boundaries(m):
                s = text[start:end]
                digits = sum(c.isdigit() for c in s)
                if digits < 7 or end - start > 40:
                    continue
                groups = "-".join(str(len(g)) for g in re.findall(r"\d+", s))
                seps = "".join(sorted(set(re.sub(r"[\dA-Z]", "", s))))
                before, after = around(start, end)
                lead = re.sub(r"\D", "", s)
                f = [f"n:{digits}", f"groups:{groups}", f"seps:{seps}", f"plus:{'+' in s}", f"lead1:{lead[:1]}", f"lead2:{lead[:2]}", f"tail:{s[-1].isalpha()}", f"head:{s[0].isalpha()}", f"n+lead:{digits}:{lead[:1]}", f"after:{after}", f"alone:{not before and after == '$'}", f"n+seps:{digits}:{seps}"]
                f += [f"w{i}:{w}" for i, w in enumerate(reversed(before))] + [f"near:{w}" for w in before]
                if more:
                    f += [f"more:{more}", f"n+more:{digits}:{more}"]
                for t in ("phone", "id_number"):
                    out.append((start, end, t, [f"{t}|{x}" for x in ["bias", *f]]))
        for k, pattern in enumerate(_STREET):
            for m in pattern.finditer(text):
                if m.end() - m.start() > MOST_CHARS:
                    continue
                cue = (m.group("cue") or "c/").lower()
                whole = m.group()
                # Also without its last parts, as long as a number is left.
                cuts = [len(whole), *[x.start() for x in re.finditer(r"\s*,", whole) if any(ch.isdigit() for ch in whole[: x.start()])]]
                for size in cuts:
                    s = whole[:size]
                    words = s.split()
                    inner = [w for w in re.findall(r"[^\W\d_][\w'’\-]*", s) if w.lower() not in _SMALL]
                    before, after = around(m.start(), m.start() + size)
                    f = [f"cue:{cue}", f"cue+no:{cue}:{bool(re.search(_NO[:-1], s, re.I))}", f"no:{bool(re.search(r'(?:n(?:o|omor|um|úm)|kav)[ .]', s, re.I))}", f"rt:{bool(re.search(r'r[tw][ .]', s, re.I))}", f"unit:{bool(re.search(r',|blok|flat', s, re.I))}", f"size:{min(8, len(words))}", f"after:{after}"]
                    f += [f"small:{w.lower()}" for w in words if w.lower() in ("di", "ke", "dari", "yang", "dan", "the", "to", "of", "in", "para", "terus", "although")]
                    f += [f"lower:{k}:{min(3, sum(w[0].islower() for w in inner))}", f"kind:{k}"] + (["more:part"] if size < len(whole) else [])
                    out.append((m.start(), m.start() + size, "address", [f"address|{x}" for x in ["bias", *f, *[f"near:{w}" for w in before[-2:]]]]))
        for pattern in (_PAIR, _LONGER):
            for m in pattern.finditer(text):
                a, between, b = m.group(1), m.group(2), m.group(3)
                ra, rb = self.roles.get(a.lower(), "n"), self.roles.get(b.lower(), "n")
                sa, sb = _shape(a), _shape(b)
                start, end = m.start(1), m.start(3) + len(b)
                kind = ""
                if pattern is _LONGER:
                    if "l" in (sa, sb) or (between.strip()[:1].islower() and not _PARTICLES.fullmatch(between.strip().lower())):
                        continue
                    kind = "particle" if between.strip()[:1].islower() else "middle"
                    if kind == "middle" and (ra not in "gb" or rb not in "fb"):
                        continue
                    between = ""
                if ra == rb == "n" and (not cued or between or "l" in (sa, sb) or min(len(a), len(b)) < 4):
                    continue
                before, after = around(start, end)
                if ra == rb == "n" and not any(c.split()[-1] in before[-2:] for c in NAME_CUES):
                    continue
                roles, shapes = f"{ra}{rb}{between}{kind}", sa + sb
                f = [f"roles:{roles}", f"shapes:{shapes}", f"roles+shapes:{roles}:{shapes}", f"after:{after}", f"roles+prev:{roles}:{before[-1] if before else '^'}", f"whole:{not before and after == '$'}"] + [f"w{i}:{w}" for i, w in enumerate(reversed(before[-2:]))]
                out.append((start, end, "name", [f"name|{x}" for x in ["bias", *f, *([f"long:{kind}"] if kind else [])]]))
        out.sort(key=lambda c: (c[1], c[0]))
        return out

    def score(self, features: list[str]) -> float:
        w = self.weights
        return sum(w.get(x, 0.0) for x in features)

    def decode(self, text: str, cued: bool = True) -> list[tuple[int, int, str, float]]:
        """The best set of segments that don't overlap: (start, end, type, score)."""
        c = [(a, b, t, s) for a, b, t, f in self.candidates(text, cued) if (s := self.score(f)) > 0]
        if len(c) < 2:
            return c
        best: list[tuple[float, int]] = []  # best score over candidates up to i, and the candidate before the one taken (-2: not taken)
        ends = [x[1] for x in c]
        for i, (a, _, _, s) in enumerate(c):
            j = i - 1
            while j >= 0 and ends[j] > a:
                j -= 1
            take = s + (best[j][0] if j >= 0 else 0.0)
            skip = best[i - 1][0] if i else 0.0
            best.append((take, j) if take > skip else (skip, -2))
        out, i = [], len(c) - 1
        while i >= 0:
            if best[i][1] == -2:
                i -= 1
            else:
                out.append(c[i])
                i = best[i][1]
        return out[::-1]


def _marginals(c: list, scores: list[float]) -> list[float]:
    """Probability of each candidate under the lattice, from forward and backward sums in log space."""
    n = len(c)
    prev = []
    for i in range(n):
        j = i - 1
        while j >= 0 and c[j][1] > c[i][0]:
            j -= 1
        prev.append(j)

    def add(x: float, y: float) -> float:
        hi, lo = max(x, y), min(x, y)
        return hi + math.log1p(math.exp(lo - hi))

    # forward[i]: all sets among the first i candidates (sorted by end).
    forward = [0.0]
    for i in range(n):
        forward.append(add(forward[i], scores[i] + forward[prev[i] + 1]))
    # The same from the right: candidates sorted by start.
    order = sorted(range(n), key=lambda i: c[i][0])
    backward, place = [0.0] * (n + 1), [c[i][0] for i in order]
    for r in range(n - 1, -1, -1):
        i, q = order[r], r + 1
        while q < n and place[q] < c[i][1]:
            q += 1
        backward[r] = add(backward[r + 1], scores[i] + backward[q])
    out = []
    for i in range(n):
        q = next((r for r in range(n) if place[r] >= c[i][1]), n)
        out.append(math.exp(min(0.0, forward[prev[i] + 1] + scores[i] + backward[q] - forward[n])))
    return out


def train(seed: int = 11, epochs: int = 6, rate: float = 0.3, penalty: float = 1e-4) -> dict[str, float]:
    """Weights by AdaGrad on the log-likelihood. Half of the training names are known by role, so that both cases are learned."""
    from quern.llm.pii_training import _FIRST, _LAST

    roles = {w: "g" for w in _FIRST[::2]} | {w: "f" for w in _LAST[::2]}
    model = Segmenter(roles)
    data = []
    for text, gold in sentences(seed):
        c = model.candidates(text)
        if c:
            # Of the boundaries proposed for a place one is right: the one that covers the segment best.
            truth = [False] * len(c)
            for ga, gb, gt in gold:
                cover = [(min(b, gb) - max(a, ga)) / (max(b, gb) - min(a, ga)) for a, b, _, _ in c]
                same = [i for i, x in enumerate(c) if x[2] == gt and cover[i] >= (0.4 if gt == "address" else 0.8)]
                if same:
                    truth[max(same, key=lambda i: cover[i])] = True
            data.append((c, truth))
    weights, squares = defaultdict(float), defaultdict(float)
    model.weights = weights
    for _ in range(epochs):
        for c, truth in data:
            scores = [model.score(f) for *_, f in c]
            for (_, _, _, f), p, y in zip(c, _marginals(c, scores), truth):
                g = float(y) - p
                if abs(g) < 1e-3:
                    continue
                for x in f:
                    step = g - penalty * weights[x]
                    squares[x] += step * step
                    weights[x] += rate * step / math.sqrt(1e-6 + squares[x])
    return {k: v for k, v in weights.items() if abs(v) > 1e-3}


class _Triggers:
    """Where a text may hold a candidate: windows around triggers, cut at line breaks."""

    def __init__(self, roles: dict[str, str], reach: int = 120):
        self.reach, self.auto = reach, ahocorasick.Automaton()
        for w in roles:
            self.auto.add_word(w, ("role", len(w)))
        for w in NAME_CUES:
            self.auto.add_word(w, ("cue", len(w)))
        for w in STREET_CUES:
            self.auto.add_word(w, ("street", len(w)))
        for w in ("@", "(at)", "[at]", *[f" {dot} {top}" for dot in ("dot", "titik", "punto", "point") for top in ("com", "org", "net", "id", "es", "fr", "co")]):
            self.auto.add_word(w, ("at", len(w)))
        self.auto.make_automaton()

    def windows(self, text: str) -> list[tuple[int, int, bool]]:
        """(start, end, whether a name cue is in it)."""
        low = text.lower()
        if len(low) != len(text):  # a letter whose lower case is longer: offsets would shift
            low = "".join(x if len(x := ch.lower()) == 1 else ch for ch in text)
        hits = []
        for end, (kind, n) in self.auto.iter(low):
            a, b = end - n + 1, end + 1
            if kind != "at":
                if (a and low[a - 1].isalnum()) or (b < len(low) and low[b].isalnum() and low[b - 1] != "/"):
                    continue
                if kind == "street" and not (n <= 3 and low[a:b] in ("jl", "jln", "gg", "kp")):
                    near = text[max(0, a - 60) : b + 80]
                    if not any(ch.isdigit() for ch in near):
                        continue
            hits.append((a, b, kind == "cue"))
        hits += [(m.start(), m.end(), False) for m in _DIGIT_RUN.finditer(text)]
        if not hits:
            return []
        hits.sort()
        out: list[tuple[int, int, bool]] = []
        for a, b, cue in hits:
            s = max(text.rfind("\n", 0, a) + 1, a - self.reach)
            e = text.find("\n", b)
            e = min(len(text) if e < 0 else e, b + self.reach)
            # No window begins or ends inside a word.
            while s > 0 and s > a - 2 * self.reach and text[s - 1] != "\n" and not text[s - 1].isspace():
                s -= 1
            while e < len(text) and e < b + 2 * self.reach and not text[e].isspace():
                e += 1
            if out and s <= out[-1][1]:
                out[-1] = (out[-1][0], max(e, out[-1][1]), out[-1][2] or cue)
            else:
                out.append((s, e, cue))
        return out


def spans_of(text: str, model: Segmenter, triggers: _Triggers) -> list[tuple[int, int, str, float]]:
    out = []
    for s, e, cue in triggers.windows(text):
        out += [(s + a, s + b, t, x) for a, b, t, x in model.decode(text[s:e], cue)]
    return out


def _finder(weights: dict[str, float], roles: dict[str, str], fields: list[str]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, triggers = Segmenter(roles, weights), _Triggers(roles)
        for p in batches:
            rows = []
            for f in fields:
                for i, t in zip(p["id"], p[f]):
                    if isinstance(t, str) and t:
                        rows += [(i, f, a, b, k, x) for a, b, k, x in spans_of(t, model, triggers)]
            yield pd.DataFrame(rows, columns=["id", "field", "start", "end", "pii_type", "score"])

    return run


def _redactor(weights: dict[str, float], roles: dict[str, str], fields: list[str]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, triggers = Segmenter(roles, weights), _Triggers(roles)
        for p in batches:
            out = {"id": p["id"]}
            for f in fields:
                values = []
                for t in p[f]:
                    if isinstance(t, str) and t:
                        for a, b, k, _ in reversed(spans_of(t, model, triggers)):
                            t = t[:a] + PLACEHOLDERS[k] + t[b:]
                    values.append(t)
                out[f] = values
            yield pd.DataFrame(out)

    return run


_SIMPLE_NAME = re.compile(r"\s*([^\W\d_]{3,}(?:-[^\W\d_]+)*)(,?)\s+([^\W\d_]{3,}(?:-[^\W\d_]+)*)")


def induced_names(docs: DataFrame, listed: dict[str, str], author_col: str = "author") -> dict[str, str]:
    """Words that stand where the other half of a listed name stands, at the front of the author field."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            rows = []
            for t in p["author"]:
                if not isinstance(t, str) or not (m := _SIMPLE_NAME.match(t)):
                    continue
                a, b = m.group(1).lower(), m.group(3).lower()
                if m.group(2):
                    a, b = b, a
                ra, rb = listed.get(a), listed.get(b)
                if ra in ("g", "b") and rb is None:
                    rows.append((b, "f", a))
                elif rb in ("f", "b") and ra is None:
                    rows.append((a, "g", b))
            yield pd.DataFrame(rows, columns=["word", "role", "partner"])

    if not listed:
        return {}
    seen = docs.select(F.col(author_col).alias("author")).mapInPandas(run, "word string, role string, partner string")
    per = seen.groupBy("word", "role", "partner").agg(F.count(F.lit(1)).alias("n")).groupBy("word", "role").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("partners"))
    found: dict[str, set[str]] = defaultdict(set)
    for r in per.filter((F.col("n") >= 3) & (F.col("partners") >= 2)).collect():
        found[r.word].add(r.role)
    return {w: "b" if len(r) > 1 else next(iter(r)) for w, r in found.items()}


def listed_names(names: DataFrame) -> dict[str, str]:
    """Lower-case name -> role from (name, name_kind): all of the list, about 100 bytes a name where it is held."""
    rows = names.select(F.lower(F.trim("name")).alias("name"), F.col("name_kind").alias("kind")).filter(F.col("name").isNotNull() & (F.col("name") != "")).distinct().collect()
    out: dict[str, str] = {}
    for r in rows:
        role = "g" if r.kind == "given" else "f"
        out[r.name] = role if out.get(r.name, role) == role else "b"
    return out


def name_roles(docs: DataFrame, names: DataFrame, author_col: str = "author") -> dict[str, str]:
    listed = listed_names(names)
    return induced_names(docs, listed, author_col) | listed


def find_pii(docs: DataFrame, roles: dict[str, str], id_col: str = "document_id", fields: tuple[str, ...] = ("body", "author"), weights: dict[str, float] | None = None) -> DataFrame:
    """(id, field, start, end, pii_type, score): character spans, start from 0, end exclusive."""
    run = _finder(weights or train(), roles, list(fields))
    return docs.select(F.col(id_col).alias("id"), *fields).mapInPandas(run, "id long, field string, start int, end int, pii_type string, score double")


def redact_pii(docs: DataFrame, roles: dict[str, str], id_col: str = "document_id", fields: tuple[str, ...] = ("body", "author"), weights: dict[str, float] | None = None) -> DataFrame:
    """(id, *fields) with every segment replaced by its placeholder; the rest of each text is unchanged."""
    run = _redactor(weights or train(), roles, list(fields))
    return docs.select(F.col(id_col).alias("id"), *fields).mapInPandas(run, "id long, " + ", ".join(f"{f} string" for f in fields)).withColumnRenamed("id", id_col)


__all__ = ["TYPES", "Segmenter", "find_pii", "induced_names", "listed_names", "name_roles", "redact_pii", "spans_of", "train"]
