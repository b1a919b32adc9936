"""Quality rules by weak supervision (operator 9).

Each rule votes good (+1), bad (-1) or abstains (0).  A latent-class model over
the votes (good, and kinds of junk; for each the chance that a rule which votes
says bad) is fitted by expectation-maximisation.  It gives each rule's accuracy,
and a document's posterior probability of being good, which replaces the
all-must-pass filter.  An abstention says nothing about the class.

Votes alone can't tell a rule that is often wrong from junk that only this rule
sees, so two things are given: that every rule has a kind of junk of its own
(``kinds=False``: one kind for all rules), and what a rule is like before any
document was seen, worth ``PRIOR`` documents at every size of the input.  All else comes
from the documents.  Each text is counted once, in the only pass over the texts.

What EM needs is how often each vote pattern occurs: one map-side aggregated
count over all documents with at most 3 ** len(RULES) = 6,561 rows whatever the
input's size, so those counts go to the driver and nothing else does.

Defined results: a null or empty text has no words, all counts are 0, it fails
the base rules and is rejected.  Rows are judged one by one, so repeated rows
each get their verdict; an empty table gives an empty result.  Extra columns
are left alone (``judge`` adds one column under a free name).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalytics.llm.common import WHITE, free_name, text_or_empty, written_in_small_batches

SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
UPPER, LOWER, DIGITS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789"


def statistics(text: str) -> dict[str, int]:
    raw = text.encode()
    words = raw.split()
    n = len(words)
    lines = [x for x in text.split("\n") if x.strip(WHITE)]
    count = lambda chars: len(raw) - len(raw.translate(None, chars))
    return {
        "n_words": n,
        "word_chars": len(text) - count(WHITE.encode()),
        "n_symbols": count(SYMBOLS),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": repeated_words(words),
        "n_lines": len(lines),
        "n_upper": count(UPPER),
        "n_letters": count(UPPER + LOWER),
        "n_digits": count(DIGITS),
        "n_shouts": count(b"!"),
    }


def repeated_words(words: list[bytes]) -> int:
    """Words inside a 3-word window that occurs twice or more in the text."""
    n = len(words)
    if n < 4:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, n)
    k = len(known)
    # windows as exact integers: number the pairs first, so the key stays below 2 ** 63
    _, pair = np.unique(ids[:-1] * k + ids[1:], return_inverse=True)
    _, back, times = np.unique(pair[:-1] * k + ids[2:], return_inverse=True, return_counts=True)
    again = times[back] > 1
    inside = np.zeros(n, bool)
    for shift in range(3):
        inside[shift : n - 2 + shift] |= again
    return int(inside.sum())


def _vote(bad: bool, good: bool) -> int:
    return -1 if bad else int(good)


#: Rule name -> vote from a text's statistics.
RULES = {
    "length": lambda s: _vote(s["n_words"] < 5, s["n_words"] >= 100),
    "word_length": lambda s: _vote(
        not 2.5 * s["n_words"] <= s["word_chars"] <= 15 * s["n_words"],
        3 * s["n_words"] <= s["word_chars"] <= 12 * s["n_words"],
    ),
    "symbols": lambda s: _vote(s["n_symbols"] > 0.1 * s["n_words"], s["n_symbols"] < 0.02 * s["n_words"]),
    "lines": lambda s: _vote(s["n_dup_lines"] > max(1, 0.3 * s["n_lines"]), s["n_dup_lines"] <= 1),
    "repeats": lambda s: _vote(
        s["n_repeat_words"] > 0.4 * s["n_words"], s["n_repeat_words"] < 0.25 * s["n_words"]
    ),
    "capitals": lambda s: _vote(s["n_upper"] > 0.4 * s["n_letters"], s["n_upper"] < 0.15 * s["n_letters"]),
    "shouting": lambda s: _vote(s["n_shouts"] > 0.2 * s["n_words"], s["n_shouts"] < 0.02 * s["n_words"]),
    "digits": lambda s: _vote(s["n_digits"] > 0.2 * s["word_chars"], s["n_digits"] < 0.05 * s["word_chars"]),
}


def pattern(stats: dict[str, int]) -> int:
    """The votes as one number in base 3."""
    code = 0
    for rule in RULES.values():
        code = 3 * code + rule(stats) + 1
    return code


def _votes(code: np.ndarray) -> np.ndarray:
    """Pattern numbers -> matrix of 0 (bad), 1 (abstains), 2 (good)."""
    m = len(RULES)
    return code[:, None] // 3 ** np.arange(m - 1, -1, -1)[None, :] % 3


@dataclass(frozen=True)
class VoteModel:
    share: np.ndarray  # of each class: good, then the kinds of junk
    chance: np.ndarray  # [class, rule]: that a vote, if there is one, is bad

    def classes(self, codes: np.ndarray) -> np.ndarray:
        """Posterior of every class (columns) for vote patterns (rows)."""
        votes = _votes(np.asarray(codes, np.int64))
        bad, good = (votes == 0).astype(float), (votes == 2).astype(float)
        log = np.log(self.share)[None] + bad @ np.log(self.chance).T + good @ np.log(1 - self.chance).T
        odds = np.exp(log - log.max(1, keepdims=True))
        return odds / odds.sum(1, keepdims=True)

    def posterior(self) -> np.ndarray:
        """Probability of a good document for every possible vote pattern."""
        return self.classes(np.arange(3 ** len(RULES)))[:, 0]

    def accuracies(self, codes, counts) -> np.ndarray:
        """For each rule the estimated share of right ones among its votes."""
        votes, good = _votes(np.asarray(codes, np.int64)), self.classes(codes)[:, :1]
        weight = np.asarray(counts, float)[:, None]
        right = weight * ((votes == 0) * (1 - good) + (votes == 2) * good)
        return right.sum(0) / np.maximum(1e-9, (weight * (votes != 1)).sum(0))


#: Documents that the prior of a class is worth: few, so that rules are judged by the data.
PRIOR = 10.0
#: Before any document was seen: a vote on a good text is bad, a rule sees its own junk, and
#: (worth one document) it sees another rule's.
WRONG, SEES, OTHERS = 0.01, 0.9, 0.05


def expectation_maximisation(codes, counts, kinds: bool = True, rounds: int = 1000, tolerance: float = 1e-7) -> VoteModel:
    """Fit on vote patterns and how many documents have each.

    With ``kinds`` the bad class is a mixture with one kind of junk for each rule: two
    rules that never agree may each see a kind of its own, which a single bad class
    would have to call an error of one of them.  What a rule votes on other kinds is
    learned.  A rule is taken to be better than chance on good texts and on its own
    junk, which keeps the names of the classes.  Rounds end when the classes of all
    documents together change by less than ``tolerance`` of them.
    """
    codes, counts = np.asarray(codes, np.int64), np.asarray(counts, float)
    m, votes = len(RULES), _votes(codes)
    bad, good = (votes == 0).astype(float), (votes == 2).astype(float)
    own = (np.arange(1, m + 1), np.arange(m)) if kinds else (np.ones(m, int), np.arange(m))
    lean = np.full((1 + m if kinds else 2, m, 2), [OTHERS, 1 - OTHERS])
    lean[0] = PRIOR * np.array([WRONG, 1 - WRONG])
    lean[own] = PRIOR * np.array([SEES, 1 - SEES] if kinds else [0.5, 0.5])
    if kinds:
        n_bad = bad.sum(1, keepdims=True)
        clean = np.where(n_bad > 0, 0.1**n_bad, 0.99)
        shares = np.concatenate([clean, (1 - clean) * np.where(n_bad > 0, bad / np.maximum(1, n_bad), 1 / m)], 1)
    else:
        clean = (good.sum(1, keepdims=True) + 1) / ((good + bad).sum(1, keepdims=True) + 2)
        shares = np.concatenate([clean, 1 - clean], 1)
    for _ in range(rounds):
        weight = shares * counts[:, None]
        chance = (lean[:, :, 0] + weight.T @ bad) / (lean.sum(2) + weight.T @ (bad + good))
        chance[0] = np.minimum(chance[0], 0.5)
        chance[own] = np.maximum(chance[own], 0.5 if kinds else chance[0])
        share = (weight.sum(0) + 1) / (weight.sum() + len(lean))
        model = VoteModel(share, chance)
        before, shares = shares, model.classes(codes)
        if (np.abs(shares - before) * counts[:, None]).sum() <= tolerance * counts.sum():
            break
    return model


COUNTED = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, code int"
JUDGED = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, posterior double, kept boolean"
)


def _counted(text: Column) -> Column:
    @F.pandas_udf(COUNTED)
    def of(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            s = statistics(t)
            failed = s["n_words"] < MIN_WORDS or 100 * s["n_repeat_words"] > 50 * s["n_words"]
            rows.append((*list(s.values())[:5], failed, pattern(s)))
        return pd.DataFrame(rows, columns=[c.split()[0] for c in COUNTED.split(", ")])

    return of(text)


def _fitted(counted: DataFrame, name: str) -> tuple[VoteModel, list[int]]:
    rows = counted.groupBy(f"{name}.code").count().collect()  # one row a vote pattern
    codes = [r["code"] for r in rows]
    return expectation_maximisation(codes, [r["count"] for r in rows]), codes


def fit(docs: DataFrame, text: str = "text") -> VoteModel:
    return _fitted(docs.select(_counted(text_or_empty(text)).alias("counted")), "counted")[0]


def judge(docs: DataFrame, text: str = "text", min_quality: float = 0.5, columns: list[str] | None = None) -> tuple[DataFrame, str]:
    """``docs`` (or only ``columns`` of it) with one more column, a struct of JUDGED; also the
    column's name.  The counts of all texts are written once, beside the columns."""
    name = free_name(docs, "verdict")
    kept = [F.col(f"`{c}`") for c in (docs.columns if columns is None else columns)]
    counted = written_in_small_batches(docs.select(*kept, _counted(text_or_empty(text)).alias(name)), "counted")
    model, codes = _fitted(counted, name)
    place = free_name(docs, "pattern")
    chance = model.classes(codes)[:, 0] if codes else []
    table = pa.table({place: pa.array(codes, pa.int32()), f"{place}_chance": pa.array(chance, pa.float64())})
    # at most 3 ** len(RULES) short rows; as an Arrow table they are part of the plan, where a list
    # of rows would start Python workers of another kind on the executors
    chances = docs.sparkSession.createDataFrame(table)
    judged = counted.join(F.broadcast(chances), F.col(f"{name}.code") == F.col(place), "left")
    fields = [F.col(f"{name}.{c.split()[0]}") for c in JUDGED.split(", ")[:6]]
    posterior = F.col(f"{place}_chance")
    good = ~F.col(f"{name}.base_failed") & (posterior >= min_quality)
    verdict = F.struct(*fields, posterior.alias("posterior"), good.alias("kept"))
    return judged.withColumn(name, verdict).drop(place, f"{place}_chance"), name


def keep_good(docs: DataFrame, text: str = "text", min_quality: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that the method keeps, columns unchanged."""
    judged, name = judge(docs, text, min_quality)
    return judged.filter(F.col(f"{name}.kept")).drop(name)
