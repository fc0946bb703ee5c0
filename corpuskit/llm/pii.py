"""Personal data: fixed patterns, and identifiers found by bootstrapped contexts.

The fixed patterns (mail addresses, IP addresses, card and phone numbers) give
the base spans. They are the seeds, and so are secrets: quoted strings that a
word for a credential is set to. All other tokens with a digit or an @, runs of
up to four numbers, and spelt-out addresses are instances that may be more of
the same.

What stands around an instance, and its shape, are lexical patterns, from exact
to general: three or two words before it, both neighbours, two words after it,
the shape after a word, the shape alone. (A single neighbour says too little: it
made numbers next to common words identifiers.) A graph links patterns with instances. Scores
are iterated over the graph, in Spark: a pattern is as trustworthy, for a kind,
as the part of its instances that is known to be of that kind, smoothed. An instance
without a label isn't a wrong one: most identifiers that no base pattern finds are among
these, and parts of one number are several. So it counts for ``DOUBT`` of one that is known to be wrong
(refused, or a seed of another kind). An instance is as trustworthy as the patterns that it has. Patterns of high
confidence make their instances known for the next round, in which these support
further patterns. What the base pattern of a kind matches but its test refuses,
such as a number with a wrong check digit, is known not to be an identifier: it
counts against its patterns and is never added.

Instances outside the base spans that a pattern of high confidence covers are
added with the kind of the pattern. What stays undiscoverable: names and
addresses in words, and identifiers without a digit or an @ that aren't spelt out.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskit.llm import scratch

KINDS = ("email", "ip", "card", "phone")
#: The kinds of all spans, in their order.
ALL_KINDS = (*KINDS, "secret")

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: A run of digits that no match follows at its start has none inside; so only starts of runs are tried.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
SIGN = re.compile(r"[0-9@]")
#: A token of printable characters; edges are taken off afterwards.
TOKEN = re.compile(r"[^\s]+")
EDGES = ".,;:!?()[]{}<>\"'`*#$%&|"
#: A number as it stands in a run of several, from its first digit on; what may stand before it.
NUMBER = re.compile(r"[0-9][0-9().-]{0,40}")
BEFORE_NUMBER = frozenset(" \t\n\r\"'<[{,;:=")
#: A mail address that is spelt out, and what gives one away.
SPELT = re.compile(r"(?<![\w.+-])[A-Za-z0-9._%+-]{1,64}+ ?(?:[(\[{]at[)\]}]| at ) ?[A-Za-z0-9-]{1,64}(?: ?(?:[(\[{]dot[)\]}]| dot |\.) ?[A-Za-z0-9-]{1,64}){1,4}", re.I)
SPELT_SIGN = re.compile(r"[(\[{][aA][tT][)\]}]| [dD][oO][tT] ")
#: Words for credentials (fixed values), and a quoted string that something is set to.
CREDENTIAL = re.compile(r"(?i)(?<![a-z0-9])(?:api[_-]?key|access[_-]?key|secret[_-]?key|client[_-]?secret|secret|access[_-]?token|auth[_-]?token|token|passwd|password)[\"']?\s{0,4}\Z")
ASSIGNED = re.compile(r"[:=]\s{0,4}[\"']([^\s\"']{16,200})[\"']")
WORD = re.compile(r"[^\W_]+|[^\w\s]|_")
SHAPE = re.compile(r"(?P<mix>(?=[0-9]*[A-Za-z])(?=[A-Za-z]*[0-9])[A-Za-z0-9]{12,})|(?P<digits>[0-9]+)|(?P<upper>[A-Z]+)|(?P<lower>[a-z]+)|(?P<letters>[^\W\d_]+)")
#: What an instance without a label counts against a pattern, where one that is known to be wrong counts 1.
DOUBT = 0.25
#: Tokens and runs up to this many characters can be identifiers.
LONGEST = 80


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += d if k % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        match = DOMAIN.match(text, at) if start < at else None
        if match:
            found.append((start, match.end()))
            free = match.end()
        at = text.find("@", max(at + 1, free))
    return found


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Leftmost, non-overlapping matches of each kind; those that fail their test are dropped."""
    spans = [("email", *s) for s in emails(text)]
    if DIGIT.search(text):
        for m in IP.finditer(text) if "." in text else ():
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
                spans.append(("ip", *m.span()))
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 16:
                digits = m.group().replace(" ", "").replace("-", "")
                if 16 <= len(digits) <= 19 and luhn(digits):
                    spans.append(("card", *m.span()))
        for m in PHONE.finditer(text) if "+" in text else ():
            if 8 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
                spans.append(("phone", *m.span()))
    return spans


def secrets(text: str) -> list[tuple[int, int]]:
    """Quoted strings that a credential is set to, if they hold letters and digits and vary as a key does."""
    found = []
    for m in ASSIGNED.finditer(text):
        value = m[1]
        if not CREDENTIAL.search(text[max(0, m.start() - 24) : m.start()]):
            continue
        counts = Counter(value)
        bits = -sum(n / len(value) * math.log2(n / len(value)) for n in counts.values())
        if bits >= 3 and any(c.isdigit() for c in counts) and any(c.isalpha() for c in counts):
            found.append(m.span(1))
    return found


def numbers(text: str) -> list[tuple[int, int]]:
    """Places of numbers that white space or a mark stands before, with a plus and a bracket."""
    found = []
    for m in NUMBER.finditer(text):
        s = m.start()
        s -= s > 0 and text[s - 1] == "("
        s -= s > 0 and text[s - 1] == "+"
        if not s or text[s - 1] in BEFORE_NUMBER:
            found.append((s, m.end()))
    return found


def spelt(text: str) -> list[tuple[int, int]]:
    """Places of mail addresses with their signs in words."""
    found, free = [], 0
    for sign in SPELT_SIGN.finditer(text):
        if sign.start() >= free and (m := SPELT.search(text, max(free, sign.start() - 140), sign.end() + 300)):
            found.append(m.span())
            free = m.end()
    return found


def refused(surface: str) -> bool:
    """Whether a base pattern matches the whole of it but the test of the kind fails."""
    if IP.fullmatch(surface) or CARD.fullmatch(surface):
        digits = surface.replace(" ", "").replace("-", "")
        return "." in surface or 16 <= len(digits) <= 19 and not luhn(digits)
    return False


def shape(surface: str) -> str:
    """Runs of digits with their length, runs of letters without, long mixed runs by length; other characters as they are."""

    def run(m: re.Match) -> str:
        if m["mix"]:
            return f"<{len(m[0])}>"
        return f"9{len(m[0])}" if m["digits"] else "A" if m["upper"] else "a"

    return SHAPE.sub(run, surface)


def patterns(text: str, start: int, end: int) -> list[str]:
    """What the place of an instance, and its form, say about it, from exact to general."""
    before = WORD.findall(text[max(0, start - 64) : start].lower())[-3:]
    after = WORD.findall(text[end : end + 64].lower())[:2]
    left, right, form = before[-1] if before else "^", after[0] if after else "$", shape(text[start:end])
    made = [f"lr {left} {right}", f"s {form}", f"ls {left} {form}"]
    made += [f"l{n} {' '.join(before[-n:])}" for n in (2, 3) if len(before) >= n]
    return made + [f"r2 {' '.join(after)}"] * (len(after) == 2)


def instances(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int, int, bool, list[str]]]:
    """(kind, start, end, digest of the surface, refused, patterns) of seeds and of all that may be more of them.

    The kind of what is no seed is "". What overlaps a base span is left out.
    """
    covered = sorted((s, e) for _, s, e in spans)
    places: dict[tuple[int, int], str] = {(s, e): kind for kind, s, e in spans}
    candidates: list[tuple[int, int, str]] = [(s, e, "secret") for s, e in secrets(text)]
    done = 0
    while (hit := SIGN.search(text, done)) is not None:
        s = hit.start()
        while s > done and not text[s - 1].isspace() and hit.start() - s <= LONGEST:
            s -= 1
        e = done = TOKEN.match(text, hit.start(), min(len(text), hit.start() + LONGEST + 1)).end()
        while s < e and text[s] in EDGES:
            s += 1
        while s < e and text[e - 1] in EDGES:
            e -= 1
        candidates.append((s, e, ""))
    run = numbers(text)
    for i, (s, _) in enumerate(run):
        for j in range(i + 1, min(i + 4, len(run))):
            if text[run[j - 1][1] : run[j][0]] != " ":
                break
            e = run[j][1]
            while text[e - 1] in ".-(":
                e -= 1
            if 7 <= sum(c.isdigit() for c in text[s:e]) <= 19:
                candidates.append((s, e, ""))
    candidates += [(*place, "") for place in spelt(text)]
    candidates.sort()
    k = 0
    for s, e, kind in candidates:
        while k < len(covered) and covered[k][1] <= s:
            k += 1
        if s < e and (kind or e - s <= LONGEST) and not (k < len(covered) and covered[k][0] < e):
            places[s, e] = places.get((s, e)) or kind
    found = []
    for (s, e), kind in places.items():
        surface = text[s:e]
        found.append((kind, s, e, xxhash.xxh64_intdigest(surface.encode()) - (1 << 63), not kind and refused(surface), patterns(text, s, e)))
    return found


def score_graph(links: DataFrame, confidence: float = 0.8, least: int = 5, rounds: int = 4, smooth: float = 1.0, doubt: float = DOUBT) -> DataFrame:
    """Trusted patterns from ``links`` (pattern, instance, kind, refused), one row for each pattern and instance.

    ``kind`` is that of a seed, else "". Returns ``pattern``, ``kind``,
    ``confidence`` and ``known`` (seeds and instances that became known) of
    patterns with ``confidence`` and ``least`` known instances at least.
    """
    links = scratch.materialise(links, "graph")
    labelled = F.count(F.when((F.col("kind") != "") | F.col("refused"), 1))
    totals = links.groupBy("pattern").agg(labelled.alias("labelled"), (F.count("*") - labelled).alias("open"))
    counts = [F.count("*").alias("known"), F.count("*").cast("double").alias("good"), F.lit(0).cast("bigint").alias("met")]
    seeds = links.where("kind <> ''").groupBy("pattern", "kind").agg(*counts)
    seeds = scratch.materialise(seeds.join(totals, "pattern"), "seeds")
    unknown = links.where("kind = '' and not refused").select("pattern", "instance")
    support, before = seeds, -1
    for _ in range(rounds):
        share = F.col("good") / (F.col("labelled") + F.col("met") + doubt * (F.col("open") - F.col("met")) + smooth)
        trusted = support.withColumn("confidence", share).where((F.col("confidence") >= confidence) & (F.col("known") >= least))
        trusted = scratch.materialise(trusted.select("pattern", "kind", "confidence", "known"), "patterns")
        if (size := trusted.agg(F.sum("known")).first()[0] or 0) == before:
            break
        before = size
        # An instance is wrong only if all its trusted patterns are. One that several kinds claim is of the likeliest.
        wrong = F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-6))))
        scored = unknown.join(trusted, "pattern").groupBy("instance", "kind").agg((1 - F.exp(wrong)).alias("score"))
        known = scored.groupBy("instance").agg(F.max(F.struct("score", "kind")).alias("best")).select("instance", "best.*")
        more = unknown.join(known, "instance").groupBy("pattern", "kind").agg(F.count("*").alias("known"), F.sum("score").alias("good"), F.count("*").alias("met"))
        both = seeds.select("pattern", "kind", "known", "good", "met").union(more)
        support = both.groupBy("pattern", "kind").agg(*(F.sum(c).alias(c) for c in ("known", "good", "met"))).join(totals, "pattern")
    return trusted


def find_personal_data(docs: DataFrame, confidence: float = 0.8, least: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Find personal data in every whole text.

    Returns a row for each row of ``docs``: the id, ``base`` and ``added``
    (arrays of (kind, start, end) in code points, the end exclusive), both by
    kind, as ``ALL_KINDS`` lists them, then start, and ``seeded``, the added spans that
    are seeds. Secrets that are seeds, and instances that a trusted pattern (see
    ``score_graph``) covers, are added.
    Added spans overlap neither base spans nor each other: of those that
    overlap, the one that starts first stays, and of these the longest.

    Null and empty texts have no spans. Null and repeated ids pass through, one
    row out for each row in. An empty table, and one without any seed, is fine.
    Only the two named columns are read.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    item = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("instance", pa.int64()), ("refused", pa.bool_()), ("patterns", pa.list_(pa.string()))])
    names = ("kind", "start", "end", "instance", "refused", "patterns")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bases, items = [], []
            for value in batch.column(1):
                text = value.as_py() or ""
                spans = base_spans(text) if SIGN.search(text) else []
                bases.append([dict(zip(names, s)) for s in spans])
                items.append([dict(zip(names, i)) for i in instances(text, spans)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bases, pa.list_(span)), pa.array(items, pa.list_(item))], names=["id", "base", "items"])

    spans = "array<struct<kind:string,start:bigint,end:bigint>>"
    held = "array<struct<kind:string,start:bigint,end:bigint,instance:bigint,refused:boolean,patterns:array<string>>>"
    scanned = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(scan, f"id {kind}, base {spans}, items {held}")
    scanned = scratch.materialise(scanned.withColumn("row", F.monotonically_increasing_id()), "spans")
    items = scanned.select("row", F.explode("items").alias("i")).select("row", "i.*")
    links = items.select(F.explode("patterns").alias("pattern"), "instance", "kind", "refused")
    links = links.groupBy("pattern", "instance").agg(F.max("kind").alias("kind"), F.max("refused").alias("refused"))
    trusted = score_graph(links, confidence, least).select("pattern", F.col("kind").alias("its"), "confidence")
    fresh = items.where("kind = '' and not refused").select("row", "start", "end", F.explode("patterns").alias("pattern")).join(trusted, "pattern")
    fresh = fresh.groupBy("row", "start", "end").agg(F.max(F.struct("confidence", "its")).alias("best")).select("row", F.col("best.its").alias("kind"), "start", "end")
    fresh = fresh.union(items.where("kind = 'secret'").select("row", "kind", "start", "end"))
    # A text's added spans come together again: at most as many as its own tokens and runs.
    added = fresh.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", (-F.col("end")).alias("back"), "kind"))).alias("found"))
    first = F.aggregate("found", F.struct(F.lit(0).cast("bigint").alias("end"), F.array().cast(spans).alias("kept")), _keep_apart, lambda state: state["kept"])
    secret = F.transform(F.filter("items", lambda i: i["kind"] == "secret"), lambda i: F.struct(i["kind"].alias("kind"), i["start"].alias("start"), i["end"].alias("end")))
    both = scanned.select("id", "base", "row", secret.alias("secrets")).join(added.select("row", first.alias("added")), "row", "left")
    both = both.select(F.col("id").alias(id_col), "base", in_order(F.coalesce("added", F.array().cast(spans))).alias("added"), "secrets")
    return both.withColumn("seeded", F.array_intersect("added", "secrets")).drop("secrets")


def _keep_apart(state: Column, found: Column) -> Column:
    """One step of the fold over spans by start: those that begin before the last one's end are left out."""
    kept = F.struct(found["kind"].alias("kind"), found["start"].alias("start"), (-found["back"]).alias("end"))
    free = found["start"] >= state["end"]
    return F.struct(F.when(free, -found["back"]).otherwise(state["end"]).alias("end"), F.when(free, F.array_append(state["kept"], kept)).otherwise(state["kept"]).alias("kept"))


def in_order(spans: Column) -> Column:
    """Spans by kind, as ``ALL_KINDS`` lists them, then start."""
    place = F.array(*map(F.lit, ALL_KINDS))
    keyed = F.transform(spans, lambda s: F.struct(F.array_position(place, s["kind"]).alias("place"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    return F.transform(F.array_sort(keyed), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


def joined(spans) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
