"""Personal data by weak supervision.

Labelers look at candidate spans and vote for, against, or not at all: the
kind's strict form (regex), word lists around and inside the span (gazetteers),
and the context on either side.  Expectation maximisation over the counts of
all vote patterns estimates how reliable each labeler is; the posteriors are
the soft labels of a final logistic classifier over votes and shape, which
decides about the candidates.  Strict forms are base spans and always stay;
the classifier adds looser ones (numbers without a plus, written-out
addresses, cards and addresses that fail a check but stand where one is named).

Texts are read once: candidates are stored with their votes, the patterns are
counted over all documents (there are few distinct ones, whatever the number of
documents), and the decision is looked up by pattern.

Defined cases: null text counts as empty; empty texts and texts without
candidates have zero counts and empty strings; repeated rows are answered
each; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import map_texts, stored
from .linear import lasso_logistic, sigmoid
from .words import slices

KINDS = ("email", "ip", "card", "phone")
ACCEPT_AT = 0.9
_CONTEXT = 40          # characters looked at on either side
_ROUNDS = 50

# Base forms.  Where a form opens with a run of one class, the run's start is the leftmost match, so matching
# from there only (or outwards from the "@") finds the same spans in linear time.
_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

# Looser forms.
_WRITTEN_AT = re.compile(r"\x20?(?:\[at\]|\(at\)|\{at\})\x20?([A-Za-z0-9-]+(?:\x20?(?:\.|\[dot\]|\(dot\)|\{dot\})\x20?[A-Za-z0-9-]+)+)", re.I)
_PLAIN_PHONE = re.compile(r"(?<![0-9A-Za-z+.,/-])(?:\([0-9]{2,4}\)|[0-9]{3,4})[\x20.-][0-9]{3,4}[\x20.-][0-9]{4}(?![0-9A-Za-z/-])")

# Words that name a kind of data, or something else, near a span.
_NAMES_KIND = {
    "email": "email e-mail mail mailto contact write kontakt correo courriel",
    "ip": "ip address host server addr adresse login",
    "card": "card credit visa mastercard amex payment karte carte tarjeta",
    "phone": "phone tel telephone call mobile fax cell telefon teléfono téléphone",
}
_NAMES_OTHER = "version isbn order invoice id no number ref build page pages chapter section release score total"
_KIND_RE = {k: re.compile(r"\b(?:" + "|".join(map(re.escape, v.split())) + r")\b", re.I) for k, v in _NAMES_KIND.items()}
_OTHER_RE = re.compile(r"\b(?:" + "|".join(_NAMES_OTHER.split()) + r")\b[\s.:#]*$", re.I)

# Common ends of host names, and first digits of payment cards.
_ENDS = frozenset("com org net edu gov mil int info biz io co uk de fr es it nl eu us ca ch at be pl se no dk fi pt ru jp cn in br au".split())
_CARD_STARTS = re.compile(r"(?:4|5[1-5]|2[2-7]|3[47]|6(?:011|5|4)|3(?:0[0-5]|[68])|35)")


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def _local_start(text: str, at: int, lowest: int) -> int:
    start = at
    while start > lowest and text[start - 1] in _LOCAL:
        start -= 1
    return start


def candidates(text: str) -> list[tuple[int, int, int, bool]]:
    """``(kind, start, end, base)`` of all strict matches, kept or failing, and of looser ones outside them."""
    out = []
    if "@" in text:
        done = 0
        for m in _AT.finditer(text):
            start = _local_start(text, m.start(), done)
            if start < m.start():
                out.append((0, start, m.end(), True))
                done = m.end()
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            out.append((1, m.start(), m.end(), all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 13:
                digits = m.group().replace(" ", "").replace("-", "")
                if len(digits) >= 13:
                    out.append((2, m.start(), m.end(), 14 <= len(digits) <= 19 and _luhn(digits)))
        if "+" in text:
            for m in _PHONE.finditer(text):
                n = sum(c.isdigit() for c in m.group())
                out.append((3, m.start(), m.end(), 10 <= n <= 15))
        loose = [(3, m.start(), m.end(), False) for m in _PLAIN_PHONE.finditer(text)]
    else:
        loose = []
    if "at" in text.lower() and ("(" in text or "[" in text or "{" in text):
        for m in _WRITTEN_AT.finditer(text):
            start = _local_start(text, m.start(), 0)
            if start < m.start():
                loose.append((0, start, m.end(), False))
    taken = sorted((s, e) for _, s, e, _ in out)
    for k, s, e, _ in loose:
        if not any(a < e and s < b for a, b in taken):
            out.append((k, s, e, False))
    return out


def votes(text: str, kind: int, start: int, end: int, base: bool) -> tuple[str, str]:
    """The labelers' votes (``+``, ``-`` or ``.`` each) and the shape of a span."""
    name, span = KINDS[kind], text[start:end]
    digits = "".join(c for c in span if "0" <= c <= "9")
    before, after = text[max(0, start - _CONTEXT):start], text[end:end + _CONTEXT]
    v = ["+" if base else "-"]                                                               # strict form
    if kind == 0:                                                                            # what it is made of
        last = re.split(r"[^A-Za-z0-9-]+", span)[-1].lower()
        v.append("+" if last in _ENDS else "-" if last.isdigit() else ".")
    elif kind == 1:
        first = int(digits[:3] or 0) if span[:1].isdigit() else 0
        v.append("-" if span.startswith(("0.", "127.", "255.")) else "+" if first else ".")
    elif kind == 2:
        v.append("+" if _CARD_STARTS.match(digits) and len(digits) in (14, 15, 16) else "-")
    else:
        v.append("-" if len(set(digits)) <= 2 else "+" if 10 <= len(digits) <= 13 else ".")
    named = _KIND_RE[name].search(before) or _KIND_RE[name].search(after)
    other = any(r.search(before[-16:]) for k, r in _KIND_RE.items() if k != name)
    v.append("+" if named else "-" if other else ".")                                        # the kind is named nearby
    v.append("-" if _OTHER_RE.search(before) else ".")                                       # something else is
    edge = (before[-1:] + after[:1]).strip()
    v.append("-" if any(c.isalnum() or c in "_/=&#" for c in edge) else "+")                  # it stands alone
    if kind == 2:
        v.append("+" if _luhn(digits) else "-")                                              # check digit
    elif kind == 3:
        v.append("+" if span.startswith("+") or "(" in span else "." if any(c in span for c in " -.") else "-")
    else:
        v.append(".")
    groups = len(re.findall("[0-9]+", span))
    return "".join(v), f"{min(len(span), 40) // 4}:{min(len(digits), 20)}:{min(groups, 6)}"


_FOUND = "id long, spans array<struct<kind:int,start:int,end:int,base:boolean,votes:string,shape:string>>"


def find_candidates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()),
                                   ("votes", pa.string()), ("shape", pa.string())]))
        for part in slices(batches, "text"):
            out = []
            for text in part.column("text").to_pylist():
                text = text or ""
                out.append([dict(zip(("kind", "start", "end", "base", "votes", "shape"), (*c, *votes(text, *c)))) for c in candidates(text)])
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(out, kind)], ["id", "spans"])

    return df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text")).transform(map_texts, find, _FOUND)


def reliabilities(patterns: list[str], counts: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Expectation maximisation: the share of true spans, each labeler's chances of each vote for true and false
    ones, and the posterior of each pattern."""
    code = np.asarray([["+-.".index(c) for c in p] for p in patterns])
    n = code.shape[1]
    # start from what the votes mean: more for than against
    post = sigmoid(1.5 * ((code == 0).sum(axis=1) - (code == 1).sum(axis=1)))
    chance = np.zeros((2, n, 3))
    share = 0.5
    for _ in range(_ROUNDS):
        for t, w in enumerate((counts * (1 - post), counts * post)):
            for k in range(n):
                chance[t, k] = (np.bincount(code[:, k], w, 3) + 1.0) / (w.sum() + 3.0)
        share = float(np.clip((counts * post).sum() / counts.sum(), 0.01, 0.99))
        logs = np.log(chance)[:, np.arange(n), code].sum(axis=2)
        post = sigmoid(np.log(share / (1 - share)) + logs[1] - logs[0])
    return share, chance, post


def _features(pattern: str, shape: str) -> np.ndarray:
    length, digits, groups = (float(x) for x in shape.split(":"))
    return np.asarray([*(1.0 if c == "+" else 0.0 for c in pattern), *(1.0 if c == "-" else 0.0 for c in pattern),
                       length / 10, digits / 20, groups / 6])


def fit(found: DataFrame) -> dict[tuple[int, str, str], float]:
    """The classifier's answer for every distinct (kind, votes, shape); there are at most a few thousand."""
    rows = (found.select(F.explode("spans").alias("s")).groupBy("s.kind", "s.votes", "s.shape").agg(F.count(F.lit(1)).alias("n")).collect())
    out = {}
    for kind in range(len(KINDS)):
        mine = sorted((r["votes"], r["shape"], r["n"]) for r in rows if r["kind"] == kind)
        if not mine:
            continue
        patterns = sorted({v for v, _, _ in mine})
        total = np.zeros(len(patterns))
        for v, _, n in mine:
            total[patterns.index(v)] += n
        _, _, post = reliabilities(patterns, total)
        soft = dict(zip(patterns, post))
        x = np.stack([_features(v, s) for v, s, _ in mine])
        weight = np.asarray([n for *_, n in mine], float)
        w = lasso_logistic(x, np.asarray([soft[v] for v, _, _ in mine]), 1e-5, rounds=500, weight=weight)
        for (v, s, _), p in zip(mine, sigmoid(x @ w[:-1] + w[-1])):
            out[kind, v, s] = float(p)
    return out


_SPANS = "id long, spans array<struct<kind:string,start:int,end:int,base:boolean,chance:double>>"


def find_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id and ``spans`` by start, then kind as listed: base ones, and those the classifier accepts."""
    found = stored(find_candidates(df, id_col, text_col), "candidates")
    shared = df.sparkSession.sparkContext.broadcast(fit(found))

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        answer = shared.value
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()), ("chance", pa.float64())]))
        for batch in batches:
            out = []
            for spans in batch.column("spans").to_pylist():
                for s in spans:
                    s["chance"] = answer[s["kind"], s["votes"], s["shape"]]
                kept = [s for s in spans if s["base"] or s["chance"] >= ACCEPT_AT]
                base = [(s["start"], s["end"]) for s in kept if s["base"]]
                kept = [s for s in kept if s["base"] or not any(a < s["end"] and s["start"] < b for a, b in base)]
                kept.sort(key=lambda s: (s["start"], s["kind"]))
                out.append([{"kind": KINDS[s["kind"]], **{k: s[k] for k in ("start", "end", "base", "chance")}} for s in kept])
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(out, kind)], ["id", "spans"])

    return found.transform(map_texts, decide, _SPANS).withColumnRenamed("id", id_col)


def listed(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def masked(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id and the text with every span replaced by its kind in brackets."""
    key = "__pii_row"       # rows that share an id, or have none, are told apart by their texts
    keyed = df.select(F.col(f"`{id_col}`").alias(id_col), F.col(f"`{text_col}`").alias("text"))
    keyed = keyed.withColumn(key, F.xxhash64(F.col(f"`{id_col}`"), F.col("text")))
    spans = find_spans(keyed, key, "text").dropDuplicates([key])
    cut = F.aggregate(F.reverse("spans"), F.coalesce("text", F.lit("")), lambda t, s: F.concat(
        F.substring(t, F.lit(1), s["start"]), F.lit("["), s["kind"], F.lit("]"), F.substring(t, s["end"] + 1, F.length(t))))
    return keyed.join(spans, key).select(id_col, cut.alias("text"))
