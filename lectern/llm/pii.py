"""Personal data by weak supervision: labelers vote on spans, expectation-maximisation rates them, a classifier decides."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import short_batches, written

#: Kinds in the order in which spans that start together are listed. The first four are the base: always kept.
BASE = ("email", "ip", "card", "phone")
EXTRA = ("secret", "obfuscated", "local", "number")
KINDS = BASE + EXTRA

# Base patterns. The alternatives of one start never differ in their end, so possessive runs and the look-behind only
# keep long runs of digits linear.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
# Candidates that the base doesn't have; the classifier decides on these.
_SECRET = re.compile(r"""(?<![A-Za-z0-9])(?:token|secret|password|passwd|api[_-]?key|access[_-]?key|auth)["']?\s{0,3}[:=]\s{0,3}["']?([A-Za-z0-9_/+.-]{8,}+)""", re.IGNORECASE)
# The look-behind lets a run of address characters be tried once, from its first letter or digit on; no part has a longest length.
_ADDRESS = "A-Za-z0-9._%+-"
_OBFUSCATED = re.compile(rf"(?<![{_ADDRESS}])[._%+-]*+([A-Za-z0-9][{_ADDRESS}]*+ *+[\[(] *+at *+[\])] *+[A-Za-z0-9-]++(?: *+[\[(] *+dot *+[\])] *+[A-Za-z0-9-]{{2,}}+)+)", re.IGNORECASE)
_LOCAL_PHONE = re.compile(r"(?<![0-9+.(-])(?:\([0-9]{3}\) ?|[0-9]{3}[-.])[0-9]{3}[-.][0-9]{4}(?![0-9-])")
#: Account numbers: length by country of the gazetteer, and any other of 15 characters or more. Written without spaces or
#: in groups of four and a shorter last one. A listed country's own length goes first, so that no word after it is taken.
ACCOUNT_LENGTHS = {"DE": 22, "FR": 27, "ES": 24, "GB": 22, "IT": 27, "NL": 18, "CH": 21, "AT": 20, "BE": 16, "PT": 25}
_GROUP = " ?[A-Z0-9]"
_LISTED = "|".join(f"{country}[0-9]{{2}}(?:{_GROUP}{{4}}){{{(n - 4) // 4}}}" + (f"{_GROUP}{{{n % 4}}}" if n % 4 else "") for country, n in ACCOUNT_LENGTHS.items())
_ACCOUNT = rf"(?:{_LISTED})(?![A-Za-z0-9])|[A-Z]{{2}}[0-9]{{2}}(?:{_GROUP}{{4}}){{2}}(?:(?:{_GROUP}{{4}}){{1,5}}(?:{_GROUP}{{1,4}})?|{_GROUP}{{3}})(?![A-Za-z0-9])"
_NUMBER = re.compile(rf"(?<![0-9-])[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}(?![0-9-])|(?<![A-Za-z0-9])(?:{_ACCOUNT})")

#: Gazetteers and context words, in lower case. Fixed values.
DOMAIN_ENDS = frozenset("com org net edu gov int info biz io dev de fr es uk eu us ca it nl ch at be pt br mx jp cn in au example test".split())
CONTEXT = {
    "email": ("mail", "email", "contact", "write", "correo", "courriel", "schreiben", "kontakt"),
    "ip": ("ip", "host", "address", "server", "login", "from", "addr", "adresse"),
    "card": ("card", "visa", "mastercard", "credit", "karte", "carte", "tarjeta", "payment", "account"),
    "phone": ("phone", "call", "tel", "mobile", "fax", "whatsapp", "telefon", "téléphone", "teléfono"),
    "obfuscated": ("mail", "email", "contact", "write", "reach"),
    "local": ("phone", "call", "tel", "mobile", "fax", "telefon"),
    "number": ("ssn", "social", "security", "iban", "account", "konto", "compte", "cuenta"),
}
#: Words that speak against it: what stands behind them is a number of something, a version or a placeholder.
AGAINST = {
    "email": ("example", "sample", "placeholder"),
    "ip": ("version", "release", "section", "chapter", "build"),
    "card": ("order", "invoice", "isbn", "serial", "tracking", "ticket"),
    "phone": ("order", "invoice", "isbn", "serial", "tracking", "ticket"),
    "secret": ("example", "sample", "placeholder", "dummy", "your"),
    "obfuscated": ("example", "sample", "placeholder"),
    "local": ("order", "invoice", "isbn", "serial", "tracking", "ticket", "part", "model", "version"),
    "number": ("order", "invoice", "isbn", "serial", "tracking", "ticket", "part", "model", "version"),
}
#: Characters before a span in which context words are looked for.
BEFORE = 40
LABELERS = ("pattern", "gazetteer", "context")
#: Iterations at most; prior share of true spans; least probability at which an extra span is kept.
ITERATIONS, PRIOR, THRESHOLD = 50, 0.5, 0.5


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join([c for c in text if "0" <= c <= "9"])


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        found = _DOMAIN.match(text, at)
        if found:
            start = at
            while start > done and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                yield start, found.end()
                done = found.end()
                at = text.find("@", done)
                continue
        at = text.find("@", at + 1)


_HAS_DIGIT = re.compile(r"[0-9]")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base kinds, leftmost non-overlapping per kind, in code points; failing matches are dropped."""
    out = [(a, b, "email") for a, b in _emails(text)] if "@" in text else []
    if _HAS_DIGIT.search(text):
        out += [(m.start(), m.end(), "ip") for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14 and 14 <= len(d := _digits(m[0])) <= 19 and luhn(d):
                out.append((m.start(), m.end(), "card"))
        if "+" in text:
            out += [(m.start(), m.end(), "phone") for m in _PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return out


def extra_spans(text: str) -> list[tuple[int, int, str]]:
    """Candidates of the other kinds; whether they are personal data is for the classifier."""
    out = []
    if "=" in text or ":" in text:
        out += [(m.start(1), m.end(1), "secret") for m in _SECRET.finditer(text)]
    if "[" in text or "(" in text:
        out += [(m.start(1), m.end(1), "obfuscated") for m in _OBFUSCATED.finditer(text)]
    if _HAS_DIGIT.search(text):
        out += [(m.start(), m.end(), "local") for m in _LOCAL_PHONE.finditer(text)]
        out += [(m.start(), m.end(), "number") for m in _NUMBER.finditer(text)]
    return out


def _entropy(value: str) -> float:
    counts = [value.count(c) / len(value) for c in set(value)]
    return -sum(c * math.log2(c) for c in counts)


#: Calling codes that international numbers begin with, two digits or one, of the regions in the gazetteers. Fixed values.
CALLING_CODES = ("1", "31", "32", "33", "34", "39", "41", "43", "44", "49", "55", "52", "81", "86", "91", "61", "351")
_WORDS = re.compile(r"[^\W_]+")
_TOP = re.compile(r"[A-Za-z]{2,}")


def words_before(text: str, start: int) -> set[str]:
    """The whole words, in lower case, of the BEFORE characters in front of a span; a word that is cut there is left out."""
    a = max(0, start - BEFORE)
    found = _WORDS.findall(text[a:start].lower())
    return set(found[1:] if a and found and text[a - 1].isalnum() and text[a].isalnum() else found)


def votes(text: str, start: int, end: int, kind: str) -> tuple[int, int, int]:
    """What the labelers say of a span: 1 personal, -1 not, 0 nothing. In the order of LABELERS.

    The pattern labeler judges the form beyond what made the span a candidate, the gazetteer its parts against lists, the
    context labeler the whole words before it: CONTEXT for, AGAINST against. Each may say no where another says yes; the
    gazetteer has no list that rules out an address, a secret or a number in groups, so there it says yes or no or nothing.
    """
    value = text[start:end]
    digits = _digits(value)
    few = len(set(digits)) < 3  # 0000, 1212: placeholders
    if kind == "email":
        local, _, domain = value.rpartition("@")
        odd = local[0] == "." or local[-1] == "." or ".." in local or len(local) > 64 or not _TOP.fullmatch(domain.rsplit(".", 1)[-1])
        pattern = -1 if odd else 1
        gazetteer = 1 if domain.rsplit(".", 1)[-1].lower() in DOMAIN_ENDS else -1
    elif kind == "obfuscated":
        last = re.split(r"[^A-Za-z0-9]+", value.lower().rstrip(")]"))[-1]
        pattern = 1 if _TOP.fullmatch(last) and ".." not in value else -1
        gazetteer = 1 if last in DOMAIN_ENDS else -1
    elif kind == "ip":
        parts = value.split(".")
        pattern = -1 if any(len(p) > 1 and p[0] == "0" for p in parts) else 1
        gazetteer = -1 if parts[0] in ("0", "255") or parts == ["1", "0", "0", "0"] else 0
    elif kind == "card":
        pattern = -1 if few else 1 if len(digits) in (15, 16) else 0
        gazetteer = 1 if digits[0] in "3456" else -1
    elif kind == "phone":
        pattern = -1 if few or digits[0] == "0" else 1
        gazetteer = 1 if digits.startswith(CALLING_CODES) else -1
    elif kind == "secret":
        pattern = 1 if _entropy(value) >= 3 and any(c.isdigit() for c in value) else -1
        gazetteer = -1 if value.rstrip("._-").isalpha() else 0
    elif kind == "local":
        pattern = -1 if few or digits[3] in "01" else 1
        gazetteer = -1 if digits[0] in "01" or digits[1:3] == "11" else 1
    else:
        pattern = -1 if few or ("-" in value and (digits[:3] in ("000", "666") or digits[0] == "9" or digits[3:5] == "00")) else 1
        gazetteer = 0 if "-" in value else 1 if value[:2] in ACCOUNT_LENGTHS else -1
    before = words_before(text, start)
    if kind == "secret":  # its name stands before it anyway
        said = text[max(0, start - 1) : start] in ("'", '"')
    else:
        said = not before.isdisjoint(CONTEXT[kind])
    context = -1 if not before.isdisjoint(AGAINST[kind]) else int(said)
    return pattern, gazetteer, context


def shape(value: str) -> str:
    """Two features of a span that no labeler votes on: its length and its share of digits, in coarse steps."""
    return f"{min(7, len(value).bit_length())}{round(4 * sum(c.isdigit() for c in value) / max(1, len(value)))}"


def candidates(text: str | None) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, key): key is the span's kind, votes and shape, all that the models see of it."""
    if not text:
        return []
    out = []
    for a, b, kind in base_spans(text) + extra_spans(text):
        v = votes(text, a, b, kind)
        out.append((a, b, kind, f"{kind}|{','.join(map(str, v))}|{shape(text[a:b])}"))
    out.sort(key=lambda s: (s[0], KINDS.index(s[2]), s[1]))
    return out


def reliabilities(counts: dict[str, int], iterations: int = ITERATIONS) -> tuple[dict[str, float], dict[tuple[str, str], tuple[float, float, float, float]]]:
    """Expectation-maximisation over counted keys: (key -> probability that it is personal data, (kind, labeler) -> rates).

    Each kind has its own prior; each labeler in it the probabilities of voting yes and no on true and on other spans, with
    one true span that gets a yes and one other that gets a no added to each, so few observations decide nothing alone.
    """
    keys = sorted(counts)
    split = [(k.split("|")[0], [int(v) for v in k.split("|")[1].split(",")]) for k in keys]
    posterior = {k: min(0.95, max(0.05, 0.5 + 0.2 * sum(v))) for k, (_, v) in zip(keys, split)}
    rates: dict[tuple[str, str], tuple[float, float, float, float]] = {}
    for _ in range(iterations):
        prior: dict[str, float] = {}
        for kind in {s[0] for s in split}:
            own = [(counts[k], posterior[k], v) for k, (kd, v) in zip(keys, split) if kd == kind]
            true = sum(n * p for n, p, _ in own)
            other = sum(n * (1 - p) for n, p, _ in own)
            prior[kind] = (true + 2 * PRIOR) / (true + other + 2)
            for i, labeler in enumerate(LABELERS):
                yes_true = sum(n * p for n, p, v in own if v[i] == 1)
                no_true = sum(n * p for n, p, v in own if v[i] == -1)
                yes_other = sum(n * (1 - p) for n, p, v in own if v[i] == 1)
                no_other = sum(n * (1 - p) for n, p, v in own if v[i] == -1)
                rates[kind, labeler] = ((yes_true + 1) / (true + 2), (no_true + 0.1) / (true + 2), (yes_other + 0.1) / (other + 2), (no_other + 1) / (other + 2))
        new = {}
        for k, (kind, v) in zip(keys, split):
            odds = math.log(prior[kind] / (1 - prior[kind]))
            for i, labeler in enumerate(LABELERS):
                yt, nt, yo, no = rates[kind, labeler]
                if v[i]:
                    odds += math.log((yt if v[i] == 1 else nt) / (yo if v[i] == 1 else no))
            new[k] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
        moved = max((abs(new[k] - posterior[k]) for k in keys), default=0)
        posterior = new
        if moved < 1e-6:
            break
    return posterior, rates


def _columns(key: str) -> list[str]:
    kind, given, form = key.split("|")
    return [f"kind={kind}", *[f"{kind}:{name}={v}" for name, v in zip(LABELERS, given.split(","))], f"{kind}:length={form[0]}", f"{kind}:digits={form[1]}"]


def train(counts: dict[str, int], posterior: dict[str, float], steps: int = 400, penalty: float = 1e-3) -> dict[str, float]:
    """The final classifier: logistic regression on votes and shapes, fitted to the soft labels of all counted spans."""
    keys = sorted(counts)
    names = sorted({c for k in keys for c in _columns(k)})
    at = {c: i for i, c in enumerate(names)}
    x = np.zeros((len(keys), len(names)))
    for i, k in enumerate(keys):
        x[i, [at[c] for c in _columns(k)]] = 1
    n = np.log1p(np.array([counts[k] for k in keys], float))
    y, w = np.array([posterior[k] for k in keys]), np.zeros(len(names))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(x @ w)))
        w -= 0.5 * (x.T @ (n * (p - y)) / max(n.sum(), 1) * len(names) ** 0.5 + penalty * w)
    return dict(zip(names, w.tolist()))


def decide(key: str, model: dict[str, float]) -> float:
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(model.get(c, 0.0) for c in _columns(key))))))


def _fitted(keys: DataFrame) -> tuple[dict[str, float], dict[str, float]]:
    counts = {r.key: r.n for r in keys.groupBy("key").agg(F.sum("n").alias("n")).collect()}
    posterior, _ = reliabilities(counts)
    return train(counts, posterior), posterior


def fit(docs: DataFrame, text: str = "text") -> tuple[dict[str, float], dict[str, float]]:
    """(classifier weights, probability of every counted key) from the candidate spans of all texts.

    What the models learn from is one count per key (kind, three votes, shape: a few thousand keys at most), so the driver's
    share doesn't grow with the corpus, and no text is left out. No candidates: no weights.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}
        for batch in batches:
            for t in batch.column(0).to_pylist():
                for *_, key in candidates(t):
                    held[key] = held.get(key, 0) + 1
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["key", "n"])

    short_batches(docs.sparkSession)
    return _fitted(docs.select(text).mapInArrow(count, "key string, n long"))


def fit_to(found: DataFrame) -> tuple[dict[str, float], dict[str, float]]:
    """The same from the candidate spans that candidate_spans() has found."""
    return _fitted(found.select(F.explode("spans.key").alias("key"), F.lit(1).cast("long").alias("n")))


_SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("score", pa.float64())])


def _chosen(text: str | None, model: dict[str, float], known: dict[str, float], threshold: float) -> list[tuple[int, int, str, float]]:
    out = []
    for a, b, kind, key in candidates(text):
        if key not in known:
            known[key] = decide(key, model)
        if kind in BASE or known[key] >= threshold:
            out.append((a, b, kind, known[key]))
    return out


def _of_kind(kind: str):
    return lambda s: s["kind"] == kind


_CANDIDATE = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("key", pa.string())])


def _mapped(rows: DataFrame, keep: tuple[str, ...], column: str, make, kind: pa.DataType, sql: str) -> DataFrame:
    """The columns `keep`, then spans: make(value of `column`) as a list of that kind. No shuffle."""
    if {"spans", column} & set(keep):
        raise ValueError("keep names the result column or the one it is made of")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [kind.field(i).name for i in range(kind.num_fields)]
        one = make()
        for batch in batches:
            found = [[dict(zip(names, s)) for s in one(v)] for v in batch.column(column).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(found, pa.list_(kind))], names=[*keep, "spans"])

    short_batches(rows.sparkSession)
    source = rows.select(*[F.col(f"`{c}`") for c in keep], column)
    kinds = "".join(f"`{c}` {source.schema[c].dataType.simpleString()}, " for c in keep)
    return source.mapInArrow(run, f"{kinds}spans array<struct<{sql}>>")


def candidate_spans(docs: DataFrame, *, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The columns `keep`, then spans: array of (start, end, kind, key) of every candidate in the text, in code points."""
    return _mapped(docs, keep, text, lambda: candidates, _CANDIDATE, "start:int,end:int,kind:string,key:string")


def find(docs: DataFrame, model: dict[str, float], *, keep: tuple[str, ...] = ("doc_id",), text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The columns `keep`, then spans: array of (start, end, kind, score), in code points, by start and then kind. No shuffle.

    Base spans are always among them; others where the classifier's probability reaches the threshold. Null and empty
    texts have no spans. Repeated rows stay repeated; extra columns are ignored.
    """

    def make():
        known: dict[str, float] = {}
        return lambda t: _chosen(t, model, known, threshold)

    return _mapped(docs, keep, text, make, _SPAN, "start:int,end:int,kind:string,score:double")


def report(docs: DataFrame, *, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans ("kind:start:end", comma-joined) for every row of docs (doc_id, text).

    The texts are read once: their candidate spans are written, the models are fitted to all of them, and one score for each
    key, a few thousand at most, goes out to choose among them. Null ids and repeated rows are reported as they come; null and empty
    texts have no spans; extra columns are ignored; an empty table gives an empty result.
    """
    found = written(candidate_spans(docs), "candidates")
    model, counted = fit_to(found)
    chosen = [key for key in counted if key.split("|")[0] in BASE or decide(key, model) >= threshold]
    one_of = F.lit(chosen) if chosen else F.array().cast("array<string>")
    found = found.withColumn("spans", F.filter("spans", lambda s: F.array_contains(one_of, s["key"])))
    written_as = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    counts = [F.size(F.filter("spans", _of_kind(k))).cast("long").alias(f"n_{k}") for k in BASE]
    return found.select(
        "doc_id", *counts,
        F.sha2(F.array_join(F.transform(base, written_as), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", written_as), ",").alias("spans"),
    )


def redact(docs: DataFrame, model: dict[str, float], *, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """docs with every found span of `text` replaced by its kind in brackets, overlapping spans by the kind of the first.

    All other columns stay, whatever their names, but n_chars, if it is there, counts the new text. Texts without spans, and
    nulls, are unchanged. Repeated rows stay repeated; very long texts are read whole; an empty table stays empty.
    """
    names = docs.columns

    def one(t: str | None, known: dict[str, float]) -> str | None:
        spans = _chosen(t, model, known, threshold)
        if not spans:
            return t
        out, done = [], 0
        for i, (a, b, kind, _) in enumerate(spans):
            if a < done:
                done = max(done, b)
                continue
            out += [t[done:a], f"[{kind}]"]
            done = b
        return "".join(out) + t[done:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, float] = {}
        for batch in batches:
            old = batch.column(text).to_pylist()
            new = [one(t, known) for t in old]
            columns = [batch.column(c) for c in names]
            columns[names.index(text)] = pa.array(new, batch.schema.field(text).type)
            if "n_chars" in names:
                sizes = batch.column("n_chars").to_pylist()
                columns[names.index("n_chars")] = pa.array([n if a is b or b is None else len(b) for a, b, n in zip(old, new, sizes)], batch.schema.field("n_chars").type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    short_batches(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)
