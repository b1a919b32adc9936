"""Secret scans by grammar inference (operator 7).

Base patterns (assignments, access ids, hex strings) are matched in every whole text.
Probabilistic automata, learned by state merging from labelled credentials, then score
every candidate token by the likelihood of its format against that of an ordinary token,
and add what they accept with enough gain.

The labelled credentials are examples of public token formats, made by rule, and the
values the base patterns found: of each kind's different values the ``SAMPLE`` with the
smallest hashes (a bounded sample, as a classifier's fit may use; all documents are
searched for it; values of over ``LONGEST`` characters are no examples), topped up by made
ones to ``LEAST``, so each automaton always exists.  Values after a password's name have no
format of their own, so they are learned by shape: which kinds of characters they hold.
The ordinary tokens are ``SAMPLE`` different ones of the texts outside base spans, again those
with the smallest hashes; a model of three characters in a row is counted from them.  Scanning
is a map over the documents without a shuffle.

Defined results: a null or empty text has no span, and ``base_sha256`` is that of the
empty string; repeated rows are scanned alike; an empty table gives an empty result.  A
text is scanned whole, however long.  Of formats and spans with the same gain the first
in the order of their places counts.  Only the id and the text are read by ``scan``.
Positions are code points, ends exclusive; a span is the whole match.  ``redact``
keeps every column and writes MASK over the spans; ``n_chars``, if there, is the new
length.
"""

from __future__ import annotations

import base64
import hashlib
import math
import random
import re
import string
import zlib
from bisect import bisect_left
from collections import Counter, defaultdict
from heapq import nsmallest
from itertools import accumulate, islice

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalytics.llm.automata import Automaton, Background, learn_all
from catalytics.llm.common import TEXTS, free_name, settings, text_or_empty, written_in_small_batches

KINDS = ("assign", "access", "hex", "format")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
#: A run that is long enough: the same matches as the whole run and then its length.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
#: No format has fewer characters.
CANDIDATE = re.compile(r"[A-Za-z0-9_.-]{6,}")
SAMPLE = 1500
LEAST = 20
#: Longer values are no examples: they would fill the driver, and the automata with them.
LONGEST = 4096
#: Bits by which a format must be likelier than an ordinary token (than uniform symbols,
#: where no ordinary tokens are given).
GAIN = 12.0
#: More bits for each letter, digit or mark that a format without fixed text must gain.
BARE = 1.0
MASK = "[secret]"

_ALNUM = string.ascii_letters + string.digits
_URL = _ALNUM + "_-"
#: How a token's header begins, by its first name; most have the algorithm or the type there.
_FIRST = ["alg"] * 12 + ["typ"] * 6 + ["kid"] * 3 + ["cty", "crit", "enc", "jku", "jwk", "x5c", "x5t", "x5u", "zip"]
_HEADERS = [base64.urlsafe_b64encode(f'{{"{name}":'.encode())[:8].decode() for name in _FIRST]
#: Public credential formats: fixed text, one of a list, or (alphabet, length) or (alphabet, least, most).
FORMATS = {
    "github": ["ghp_", (_ALNUM, 36)],
    "github-oauth": ["gho_", (_ALNUM, 36)],
    "gitlab": ["glpat-", (_URL, 20)],
    "google": ["AIza", (_URL, 35)],
    "npm": ["npm_", (_ALNUM, 36)],
    "sendgrid": ["SG.", (_URL, 22), ".", (_URL, 43)],
    "slack": ["xoxb-", (string.digits, 9, 14), "-", (string.digits, 9, 14), "-", (_ALNUM, 24, 32)],
    "stripe": ["sk_live_", (_ALNUM, 24, 99)],
    "jwt": [_HEADERS, (_URL, 8, 160), ".eyJ", (_URL, 6, 1200), ".", (_URL, 43, 342)],
}


def made_examples(n: int = 200, seed: int = 7, formats: dict | None = None) -> list[tuple[str, str]]:
    """``n`` of each format: the shortest, the longest, and lengths even by their logarithm."""
    rng = random.Random(seed)

    def part(p, i: int) -> str:
        if isinstance(p, str):
            return p
        if isinstance(p, list):
            return rng.choice(p)
        least, most = p[1], p[-1]
        drawn = round(math.exp(rng.uniform(math.log(least), math.log(most)))) if least < most else least
        return "".join(rng.choices(p[0], k=least if i == 0 else most if i == 1 else drawn))

    return [(name, "".join(part(p, i) for p in parts)) for name, parts in (formats or FORMATS).items() for i in range(n)]


#: What tops up the kinds that the base patterns find.
TOP_UP = {"assign": [(_ALNUM, 6, 40)], "access": ["AKIA", (string.ascii_uppercase + string.digits, 16)], "hex": [("0123456789abcdef", 24, 64)]}


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's place in KINDS, end)."""
    found = []
    if "=" in text or ":" in text:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def base_values(text: str) -> list[tuple[str, str]]:
    out = [("assign", m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 6] if "=" in text or ":" in text else []
    out += [("access", m[0]) for m in ACCESS.finditer(text)] + [("hex", m[0]) for m in HEX.finditer(text)]
    return out


_SHAPES = [("lower", re.compile("[a-z]").search), ("upper", re.compile("[A-Z]").search), ("digit", re.compile("[0-9]").search), ("mark", re.compile("[^A-Za-z0-9]").search)]


def shape(value: str) -> str:
    """Which kinds of characters a value holds, for example ``lower+digit``."""
    return "+".join([name for name, holds in _SHAPES if holds(value)])


def _smallest(rows: DataFrame, sample: int) -> list[tuple[str, str]]:
    """(kind, value): of each kind's different values those with the smallest hashes."""
    rows = rows.filter(F.length("value") <= LONGEST).distinct().withColumn("hash", F.crc32(F.encode("value", "utf-8")))
    # a kind's rows are ranked in eight parts first, so no task has all rows of a kind
    rows = rows.withColumn("part", F.pmod(F.xxhash64("hash", F.lit(1)), F.lit(8)))
    within = Window.partitionBy("kind", "part").orderBy("hash", "value")
    rows = rows.withColumn("place", F.row_number().over(within)).filter(F.col("place") <= sample).drop("place")
    best = Window.partitionBy("kind").orderBy("hash", "value")
    rows = rows.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= sample)
    # each task sends its own smallest of a kind only
    with settings(rows.sparkSession, TEXTS | {"spark.sql.optimizer.windowGroupLimitThreshold": str(sample)}):
        return [(r["kind"], r["value"]) for r in rows.select("kind", "value").collect()]


def _touching(spans: list[tuple[int, int, int]]):
    """Whether a stretch (start, end) meets any of the sorted spans."""
    starts, ends = [s for s, _, _ in spans], list(accumulate((e for _, _, e in spans), max))

    def touches(start: int, end: int) -> bool:
        before = bisect_left(starts, end)
        return before > 0 and ends[before - 1] > start

    return touches


def ordinary_tokens(text: str) -> set[str]:
    """Candidates that don't touch a base span."""
    touches = _touching(base_spans(text))
    return {m[0] for m in CANDIDATE.finditer(text) if not touches(m.start(), m.end())}


def examples(docs: DataFrame, text: str = "text", sample: int = SAMPLE) -> tuple[list[tuple[str, str]], list[str]]:
    """Labelled credentials, and ordinary tokens, from one pass over the texts."""

    @F.pandas_udf("array<struct<kind:string, value:string>>")
    def values(texts: pd.Series) -> pd.Series:
        out, tokens = [base_values(t) for t in texts], set()
        for t in texts:
            tokens |= ordinary_tokens(t)
        if out:  # of all texts of the batch; others can't be among the smallest of all
            least = nsmallest(sample, ((zlib.crc32(x.encode()), x) for x in tokens if len(x) <= LONGEST))
            out[0] = out[0] + [("ordinary", x) for _, x in least]
        return pd.Series(out)

    found = docs.select(F.explode(values(text_or_empty(text))).alias("v")).select("v.kind", "v.value")
    rows = _smallest(found, sample)
    values_of = {x for x in rows if x[0] != "ordinary"}
    for kind, parts in TOP_UP.items():
        missing = LEAST - sum(k == kind for k, _ in values_of)
        spare = (x for x in made_examples(2 * LEAST, formats={kind: parts}) if x not in values_of)
        values_of |= set(islice(spare, max(0, missing)))
    return made_examples() + sorted(values_of), sorted(v for k, v in rows if k == "ordinary")


def labelled(docs: DataFrame, text: str = "text", sample: int = SAMPLE) -> list[tuple[str, str]]:
    """Made examples, and a bounded sample of the values that the base patterns find."""
    return examples(docs, text, sample)[0]


class Grammars:
    """Automata by label, and the model of ordinary tokens that they are compared with."""

    def __init__(self, models: dict[str, Automaton], background: Background | None = None):
        self.models, self.background = models, background
        #: first character -> (automaton, shape that its tokens have, bits to gain more a character)
        self.by_first: dict[str, list] = defaultdict(list)
        for label, model in sorted(models.items()):
            kind, _, own = label.partition(":")
            wanted = own if kind == "assign" and own != "other" else ""
            # a format without fixed text is any random text
            more = BARE if background and kind in ("assign", "hex") else 0.0
            for c in model.steps[0]:
                self.by_first[c].append((model, wanted, more))

    def gain(self, token: str) -> float:
        """Bits by which the likeliest format is likelier than an ordinary token; how long
        a token may be is left to the automaton's chances of ending."""
        best, size = -math.inf, len(token)
        for model, wanted, more in self.by_first.get(token[0], ()):
            if size >= model.shortest and (not wanted or shape(token) == wanted):
                best = max(best, model.log2_likelihood(token) - more * size)
        if best == -math.inf:
            return best
        return best - (self.background.log2_likelihood(token) if self.background else -6.0 * size)


def learned(examples: tuple[list[tuple[str, str]], list[str]]) -> Grammars:
    """Automata of all labels, those after a password's name by shape, and the background."""
    labelled, ordinary = examples
    shaped = [(f"{k}:{shape(v)}" if k == "assign" else k, v) for k, v in labelled]
    count = Counter(k for k, _ in shaped)
    # shapes with few values are learned together
    shaped = [("assign:other" if k.startswith("assign:") and count[k] < LEAST else k, v) for k, v in shaped]
    return Grammars(learn_all(shaped), Background(ordinary, _URL + ".") if ordinary else None)


def all_spans(text: str, models: dict[str, Automaton] | Grammars) -> list[tuple[int, int, int]]:
    grammars = models if isinstance(models, Grammars) else Grammars(models)
    base, added = base_spans(text), []
    touches = _touching(base)
    for m in CANDIDATE.finditer(text):
        whole, best = m[0], (-math.inf, 0, 0)
        token = whole.strip("._-")
        if token == whole:
            places = [m.span()]
        elif not token:
            continue
        else:  # marks around it belong to the token if a format with them is the likeliest
            start = m.start() + whole.index(token)
            places = dict.fromkeys([m.span(), (start, m.end()), (start, start + len(token))])
        for s, e in places:
            bits = grammars.gain(text[s:e])
            if bits > best[0] and not touches(s, e):
                best = (bits, s, e)
        if best[0] >= GAIN:
            added.append((best[1], 3, best[2]))
    return sorted(base + added)


def named(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


SCANNED = "n_assign long, n_access long, n_hex long, n_format long, base_sha256 string, spans string"


def _scan_of(text: Column, models: Grammars) -> Column:
    @F.pandas_udf(SCANNED)
    def of(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            spans = all_spans(t, models)
            base = named([x for x in spans if x[1] < 3])
            counts = [sum(x[1] == k for x in spans) for k in range(4)]
            rows.append((*counts, hashlib.sha256(base.encode()).hexdigest(), named(spans)))
        return pd.DataFrame(rows, columns=[c.split()[0] for c in SCANNED.split(", ")])

    return of(text)


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id and SCANNED for every row."""
    models = learned(examples(docs, text))
    found = docs.select("doc_id", _scan_of(text_or_empty(text), models).alias("scan"))
    return written_in_small_batches(found, "scanned").select("doc_id", "scan.*")


def masked(text: str | None, models: dict[str, Automaton] | Grammars) -> str | None:
    spans = all_spans(text, models) if text else []
    if not spans:
        return text
    out, at = [], 0
    for start, _, end in spans:
        if start >= at:
            out += [text[at:start], MASK]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with MASK for every span; all rows and columns stay."""
    models = learned(examples(docs, text))

    @F.pandas_udf("string")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([masked(t, models) for t in texts], dtype=object)

    name = free_name(docs, "masked")
    out = written_in_small_batches(docs.withColumn(name, of(F.col(text).cast("string"))), "masked")
    new = {text: F.col(name)}
    if "n_chars" in docs.columns:
        changed = ~F.col(name).eqNullSafe(F.col(text))
        new["n_chars"] = F.when(changed, F.length(name)).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return out.withColumns(new).select(*docs.columns)
