"""Personal data: fixed patterns, and bootstrapped contextual extraction of identifiers they miss.

Base spans are what the four fixed patterns find in a whole text. They seed
the bootstrap: the words around a mention are its lexical patterns (the two
words before; the word before with the word after), and Spark scores the graph
of patterns and instances in rounds. A pattern is as good as the share of its
distinct instances that are known, an instance as good as the patterns it is
met in. Mentions that look like a kind but fail its base pattern become spans
where a high-confidence pattern of that kind holds them.

Mentions are all runs with a digit or an at sign, so a pattern's instances
count against it whether or not they look like personal data. All mentions of
all texts enter the graph; a mention repeated in copies is one instance.

Defined cases: NULL text is empty and has no span; offsets count code points,
the end is exclusive; found spans never overlap base spans, which all stay;
repeated rows each get their spans, and count once as instances; very long
texts, words and numbers are read whole, in time linear in the text (long
words stand in patterns by their hash); an empty table gives no rows; other
columns are not read, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockrisk.llm.common import free_name, own_columns
from stockrisk.sources.sinks import pin

# FIXED VALUES of the query contract, in the order that ties at one start follow.
KINDS = ("email", "ip", "card", "phone")
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_BASE = {kind: re.compile(pattern) for kind, pattern in BASE.items()}

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")

# Mentions: runs of digits with the marks that stand between them, and words with an at sign.
_TRIGGER = re.compile("[0-9@]")
_NUMBER = re.compile(r"[0-9](?:[\x20().:/-]{0,2}[0-9])*")
_WORD_REST = re.compile(r"\S*")
_LEADS = ("", "+", "(", "+(")
_TAILS = ".,;:!?)\"'"
_DIGIT = re.compile("[0-9]")
ROUNDS = 3
MIN_SEEDS = 4  # distinct seed instances a pattern needs; fewer can't reach the confidence
CONFIDENCE = 0.8
LONG_WORD = 64  # longer words stand in patterns by their hash
SMALL_PATTERNS = 16 << 20  # bytes of patterns that are sent to all tasks

SCAN = (
    "doc_id string, text_key string, base array<struct<kind:int,start:int,end:int>>, "
    "mentions array<struct<start:int,end:int,form:string,kind:int,seed:int,before:string,around:string>>"
)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _holds(kind: str, found: str) -> bool:
    if kind == "email":
        return True
    if kind == "ip":
        # Without leading zeros: the interpreter refuses numbers of thousands of digits.
        parts = [p.lstrip("0") or "0" for p in found.split(".")]
        return all(len(p) <= 3 and int(p) <= 255 for p in parts)
    digits = "".join(_DIGIT.findall(found))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the email pattern, in time proportional to the text: each at sign is looked at once."""
    done = 0
    at = text.find("@")
    while at >= 0:
        before = text[done:at]
        local = len(before) - len(before.rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if local else None
        if domain:
            yield at - local, domain.end()
        done = domain.end() if domain else at + 1
        at = text.find("@", done)


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the ip pattern, in time proportional to the text: fours of a dotted run of numbers."""
    for run in _DOTTED.finditer(text):
        parts = run.group().split(".")
        start = run.start()
        for i in range(0, len(parts) - 3, 4):
            end = start + sum(map(len, parts[i : i + 4])) + 3
            yield start, end
            start = end + 1


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of all base spans, in order."""
    found: dict[str, Iterator[tuple[int, int]]] = {}
    if "@" in text:
        found["email"] = _emails(text)
    if _DIGIT.search(text):
        found["ip"] = _addresses(text)
        found |= {k: (m.span() for m in _BASE[k].finditer(text)) for k in ("card", "phone")}
    spans = []
    for number, kind in enumerate(KINDS):
        spans += [(s, number, e) for s, e in found.get(kind, ()) if _holds(kind, text[s:e])]
    return sorted(spans)


def _mentions(text: str) -> Iterator[tuple[int, int]]:
    """Spans of the mentions of a text. A number that is part of a longer word is that word."""
    done = 0
    while m := _TRIGGER.search(text, done):
        at = m.start()
        before = text[done:at]
        lead = before.rsplit(None, 1)[-1] if before and not before[-1].isspace() else ""
        end = _NUMBER.match(text, at).end() if m.group() != "@" else at
        rest = _WORD_REST.match(text, end)
        if m.group() == "@" or lead not in _LEADS or rest.group().strip(_TAILS):
            end = max(at + 1, end + len(rest.group().rstrip(_TAILS)))
        yield at - len(lead), end
        done = end


def looks_like(form: str) -> int:
    """Kind a mention resembles, or -1."""
    if "@" in form:
        left, _, right = form.partition("@")
        return 0 if re.search("[A-Za-z]", left) and re.search("[A-Za-z]", right) else -1
    digits = len(_DIGIT.findall(form))
    if form.count(".") >= 3 and not re.search(r"[\x20()/:-]", form):
        return 1
    if 12 <= digits <= 19 and not re.search(r"[().:/+]", form):
        return 2
    return 3 if 7 <= digits <= 15 and "/" not in form and ":" not in form else -1


def _short(word: str) -> str:
    """A word as patterns and instances hold it: in lower case, a long one by its hash."""
    word = word.lower()
    return word if len(word) <= LONG_WORD else f"#{xxhash.xxh64_hexdigest(word.encode('utf-8', 'surrogatepass'))}"


def _contexts(text: str, items: list[tuple[int, int]]) -> list[tuple[str, str]]:
    """Lexical patterns of the mentions of a text, given in order: the two words before each; the word on either side.

    Words are whole, however long; a mention is a word of the next one's
    context, and so is what stands between two mentions without a blank. Text
    ends count as words. The text between two mentions is split once.
    """
    befores, afters = [], []
    past, done = ["^", "^"], 0
    for start, end in items:
        gap = text[done:start].split() if start > done else []
        form = _short(text[start:end])
        if befores:
            afters.append(_short(gap[0]) if gap else form)
        past = [*past, *map(_short, gap[-2:])][-2:]
        befores.append(past)
        past = [past[-1], form]
        done = max(done, end)
    rest = text[done:].split(None, 1)
    afters.append(_short(rest[0]) if rest else "$")
    return [(" ".join(b), f"{b[-1]} _ {a}") for b, a in zip(befores, afters)]


def scan_text(text: str) -> tuple[list, list]:
    """Base spans (kind, start, end) and mentions (start, end, form, kind, seed, before, around) of a text."""
    base = base_spans(text)
    found = []
    if base or "@" in text or _DIGIT.search(text):
        low = 0
        for s, number, e in [*base, (len(text), -1, len(text))]:
            for a, b in _mentions(text[low:s]):  # nothing for a negative gap: spans that overlap
                found.append((low + a, low + b, looks_like(text[low + a : low + b].lower()), 0))
            if number >= 0:
                found.append((s, e, number, 1))
            low = max(low, e)
    contexts = _contexts(text, [f[:2] for f in found])
    mentions = [(s, e, _short(text[s:e]), kind, seed, *c) for (s, e, kind, seed), c in zip(found, contexts)]
    return [(number, start, end) for start, number, end in base], mentions


def spans_of(text: str, patterns: set[tuple[str, int]]) -> list[tuple[int, int, int]]:
    """(kind, start, end) of all spans of a text, in order: the base, and what ``patterns`` (pattern, kind) add."""
    base, mentions = scan_text(text)
    more = {(k, s, e) for s, e, _, k, seed, before, around in mentions if not seed and not patterns.isdisjoint([(f"b {before}", k), (f"a {around}", k)])}
    return sorted([*base, *more], key=lambda f: (f[1], f[0]))


def mask(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with its spans, in order, replaced by their kinds; spans that overlap by the kind of the first."""
    parts, done = [], 0
    for kind, start, end in spans:
        if start >= done:
            parts += [text[done:start], f"<{KINDS[kind].upper()}>"]
        done = max(done, end)
    return "".join([*parts, text[done:]])


def text_key(text: Column) -> Column:
    """Names a text: its SHA-256. NULL counts as the empty text."""
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def scan(docs: DataFrame) -> DataFrame:
    """Base spans and mentions of every row, written to the shared folder (a small part of the texts)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [scan_text(t or "") for t in frame["text"]]
            out = frame[["doc_id", "text_key"]].copy()
            out["base"] = [[{"kind": k, "start": s, "end": e} for k, s, e in base] for base, _ in found]
            names = ("start", "end", "form", "kind", "seed", "before", "around")
            out["mentions"] = [[dict(zip(names, m, strict=True)) for m in mentions] for _, mentions in found]
            yield out

    # The id travels as text: pandas has no long column with NULLs.
    read = docs.select(F.col("doc_id").cast("string").alias("doc_id"), text_key(F.col("text")).alias("text_key"), "text")
    found = read.mapInPandas(run, SCAN)
    return pin(found.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType)), "pii_scan")


def _patterns(mentions: DataFrame) -> DataFrame:
    """Mentions twice, once for each of their patterns (``pattern``)."""
    two = F.array(F.concat(F.lit("b "), "before"), F.concat(F.lit("a "), "around"))
    return mentions.withColumn("pattern", F.explode(two))


def good_patterns(
    scanned: DataFrame, rounds: int = ROUNDS, min_seeds: int = MIN_SEEDS, confidence: float = CONFIDENCE
) -> DataFrame:
    """High-confidence patterns after ``rounds`` rounds over the pattern-instance graph: pattern, kind, score."""
    mentions = scanned.select("text_key", F.explode("mentions").alias("m")).select("m.*")
    graph = pin(
        _patterns(mentions).groupBy("pattern", "form", "kind").agg(F.max("seed").alias("seed")), "pii_graph"
    )
    met = graph.groupBy("pattern").agg(F.countDistinct("form").alias("met"))
    known = graph.where("seed = 1").select("form", "kind").distinct().withColumn("score", F.lit(1.0))
    for last in reversed(range(rounds)):
        scored = graph.join(known, ["form", "kind"])
        good = pin(
            scored.groupBy("pattern", "kind")
            .agg(F.sum("score").alias("found"), F.sum("seed").alias("seeds"))
            .join(met, "pattern")
            .select("pattern", "kind", "seeds", (F.col("found") / (F.col("met") + 1)).alias("score"))
            .where((F.col("seeds") >= min_seeds) & (F.col("score") >= (confidence if not last else confidence / 2))),
            "pii_patterns",
        )
        if last:
            doubt = F.log(1 - F.least("score", F.lit(0.999)))
            known = (
                graph.join(good.select("pattern", "kind", "score"), ["pattern", "kind"])
                .groupBy("form", "kind")
                .agg(F.sum(doubt).alias("doubt"), F.max("seed").alias("was"))
                .select("form", "kind", (1 - F.exp("doubt")).alias("score"))
                .unionByName(known.where("score = 1.0"))
                .groupBy("form", "kind")
                .agg(F.max("score").alias("score"))
            )
    return good.select("pattern", "kind", "score")


def found_spans(scanned: DataFrame, patterns: DataFrame) -> DataFrame:
    """Spans the patterns add, once per text: text_key, more (array of kind, start, end)."""
    mentions = scanned.select("text_key", F.explode("mentions").alias("m")).select("text_key", "m.*")
    open_ = mentions.where("seed = 0 AND kind >= 0").distinct()
    hit = _patterns(open_).join(patterns.select("pattern", "kind"), ["pattern", "kind"])
    return hit.groupBy("text_key").agg(F.collect_set(F.struct("kind", "start", "end")).alias("more"))


def _with_spans(scanned: DataFrame, patterns: DataFrame) -> DataFrame:
    more = pin(found_spans(scanned, patterns), "pii_more")
    every = F.concat("base", F.coalesce("more", F.array().cast("array<struct<kind:int,start:int,end:int>>")))
    in_order = F.array_sort(F.transform(every, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
    spans = F.transform(in_order, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return scanned.join(more, "text_key", "left").select("doc_id", "text_key", "base", spans.alias("spans"))


def detect(docs: DataFrame) -> DataFrame:
    """Spans of every row: doc_id, text_key, base and spans (arrays of kind, start, end; in order)."""
    scanned = scan(docs)
    return _with_spans(scanned, good_patterns(scanned))


def redact(docs: DataFrame, small: int = SMALL_PATTERNS) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in angle brackets, and ``n_chars`` to match.

    Spans that overlap are replaced as one, by the kind of the first. Columns
    and rows stay as they are otherwise, whatever they are named; a text
    without spans is not touched. Texts are masked where they are read, by the
    patterns, while those are at most ``small`` bytes; more patterns than that
    are joined with the mentions, and the spans they give with the texts.
    """
    scanned = scan(docs)
    patterns = pin(good_patterns(scanned), "pii_good")
    size = patterns.agg(F.sum(F.octet_length("pattern") + 64)).first()[0] or 0
    name = free_name(docs, "masked")
    if size <= small:
        held = docs.sparkSession.sparkContext.broadcast({(r["pattern"], r["kind"]) for r in patterns.collect()})

        @F.pandas_udf("string")
        def masked(texts: pd.Series) -> pd.Series:
            found = [spans_of(t, held.value) if t else [] for t in texts]
            return pd.Series([mask(t, f) if f else None for t, f in zip(texts, found, strict=True)], dtype=object)

        read = docs.withColumn(name, masked("text"))
    else:

        @F.pandas_udf("string")
        def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
            found = [[] if f is None else [(s["kind"], s["start"], s["end"]) for s in f] for f in spans]
            return pd.Series([mask(t, f) if f else None for t, f in zip(texts, found, strict=True)], dtype=object)

        spans = _with_spans(scanned, patterns).where(F.size("spans") > 0).groupBy("text_key").agg(F.first("spans").alias("spans"))
        key, theirs, listed = (free_name(docs, n) for n in ("own_key", "text_key", "spans"))
        held = pin(spans, "pii_spans").withColumnsRenamed({"text_key": theirs, "spans": listed})
        joined = docs.withColumn(key, text_key(F.col("text"))).join(held, F.col(key) == F.col(theirs), "left")
        read = joined.withColumn(name, cut("text", listed))
    columns = dict(zip(docs.columns, own_columns(docs), strict=True))
    columns["text"] = F.coalesce(name, "text").alias("text")
    if "n_chars" in columns:
        changed = F.length(name).cast(docs.schema["n_chars"].dataType)
        columns["n_chars"] = F.coalesce(changed, F.col("n_chars")).alias("n_chars")
    return read.select(*columns.values())


def span_digest(docs: DataFrame) -> DataFrame:
    """The query's digest: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans."""
    names = F.array(*[F.lit(k) for k in KINDS])

    def written(spans: str) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")

    def count(number: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == number)).cast("long")

    counts = [count(number).alias(f"n_{kind}") for number, kind in enumerate(KINDS)]
    return detect(docs).select("doc_id", *counts, F.sha2(written("base"), 256).alias("base_sha256"), written("spans").alias("spans"))
