"""Secrets in texts: plain patterns, and guess costs of values in credential contexts.

Plain kinds are found by their patterns. A context is a word for a credential in
one of four languages with a separator and a value, a user and password in a URL,
or an authorization header. Its value is a secret, kind ``value``, if guessing it
is costly: dynamic programming finds the segmentation of least cost into words,
dates, repeats, keyboard walks and brute-force characters, where costs are decimal
logarithms of numbers of guesses and add up. "password: required" so is no secret,
and "pwd = 'kR7#vq9!xT2'" is one, though no plain pattern takes it.

What a word costs is what the corpus says: the number of all (document, word) pairs
over the number of documents that hold it, outside values of contexts. All texts
are read once; that gives plain spans, values and counts of words by task. Distinct
values are cut into the pieces that may be words, and meet the counts in a join; the
dynamic programming runs once for each distinct value, whose cost is then joined
back. Nothing is sent to all tasks.

Defined cases. A null text counts as empty, and has no spans. Values shorter than
``SHORTEST`` are never costly. Ids are only handed on: null and repeated ones, and
repeated rows, each give a row. Texts are read whole, in time in proportion to their
length, and a very long one needs memory of its own size a few times over; values
have no longest length. Spans with the same start are listed by kind, then by end;
one is never dropped for another that overlaps it. An empty table gives no rows.
Other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanloom.llm.common import settled, slices, small_batches

KINDS = ("assign", "access", "hex", "value")
BASE = KINDS[:3]

#: Guesses, as a decimal logarithm, from which a value is a secret; and the shortest value that is looked at.
COSTLY = 8.0
SHORTEST = 6

#: Documents that make letters a word, and the lengths that words have.
KNOWN = 3
WORD_LENGTHS = (3, 24)

#: Bytes of text that are looked at together, and copies of the costs that meet a value's places.
SLICE = 4 << 20
SALTS = 16

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ASSIGN_STEMS = ("password", "passwd", "secret", "token", "api_key", "apikey")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
#: A run that is too short fails as a whole, so only longer ones need be matched.
_HEX = re.compile(r"[0-9a-f]{24,}")

#: Words that announce a credential, in English, Spanish, German and French.
CREDENTIALS = (
    "password", "passwd", "passphrase", "passcode", "pwd", "secret", "token", "api_key", "api-key", "apikey", "access_key", "access-key", "accesskey", "private_key",
    "private-key", "credential", "credentials", "contraseña", "clave", "kennwort", "passwort", "mot de passe", "mdp",
)
#: What stands between such a word and its value.
_IS = r"(?:[\"']?\x20{0,8}(?::=|=>|->|[:=])\x20{0,8}|\x20(?:is|es|ist|est|lautet):?\x20)"
_QUOTED = r"\"(?P<double>[^\"\n]+)\"|'(?P<single>[^'\n]+)'|`(?P<back>[^`\n]+)`"
_CONTEXT = re.compile(rf"(?:{'|'.join(sorted(map(re.escape, CREDENTIALS), key=len, reverse=True))})[A-Za-z0-9_]{{0,16}}{_IS}(?:{_QUOTED}|(?P<bare>[^\s\"'`<>]+))", re.I)
_URL = re.compile(r"://[^\s:/@]{1,64}:(?P<bare>[^\s/@]+)@")
_BEARER = re.compile(r"\b(?:bearer|basic)\x20(?P<bare>[A-Za-z0-9+/_.=~-]+)", re.I)
_LOOKS = ((_CONTEXT, CREDENTIALS), (_URL, ("://",)), (_BEARER, ("bearer ", "basic ")))
_TAIL = ".,;:!?)]}"

# --- fixed values: passwords that are guessed first, and keys as they lie ---------
FIRST_GUESSES = (
    "password", "qwerty", "letmein", "welcome", "admin", "login", "master", "dragon", "monkey", "football", "baseball", "iloveyou", "sunshine", "princess", "shadow", "superman",
    "trustno", "changeme", "example", "placeholder", "default", "secret", "test", "guest", "root", "user", "your", "pass", "token", "none", "null", "redacted", "hidden", "required",
)
KEY_ROWS = (("`1234567890-=", 0.0), ("qwertyuiop[]", 1.5), ("asdfghjkl;'", 1.75), ("zxcvbnm,./", 2.25))
SHIFTED = dict(zip('~!@#$%^&*()_+{}:"<>?', "`1234567890-=[];',./"))
LEET = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "8": "b"}
# ------------------------------------------------------------------------------------

_KEYS = {c: (k + shift, row) for row, (keys, shift) in enumerate(KEY_ROWS) for k, c in enumerate(keys)}
#: Keys that a walk can start at, and ways that it can turn to.
STARTS, TURNS = len(_KEYS), 5

_DATE = re.compile(r"(?=((?P<y>(?:19|20)\d\d)(?P<s>[-/._]?)(?:0[1-9]|1[0-2])(?P=s)(?:0[1-9]|[12]\d|3[01])|(?:0?[1-9]|[12]\d|3[01])(?P<t>[-/._]?)(?:0?[1-9]|[12]\d|3[01])(?P=t)(?P<z>(?:19|20)\d\d|\d\d)))")
_YEAR = re.compile(r"(?=((?:19|20)\d\d))")
#: The year that dates are counted from, and the least distance that is counted.
TODAY, AROUND = 2020, 20
_REPEAT = re.compile(r"(.{1,8}?)\1+", re.S)
_LETTERS = re.compile(r"[^\W\d_]{3,}")


def base_spans(text: str, low: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by the plain patterns."""
    out = []
    if any(s in low for s in _ASSIGN_STEMS):
        out += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def contexts(text: str, low: str) -> list[tuple[int, int]]:
    """Where the values of credential contexts are, each once, by start."""
    found = set()
    for pattern, stems in _LOOKS:
        if any(s in low for s in stems):
            for m in pattern.finditer(text):
                a, b = m.span(m.lastgroup)
                if m.lastgroup == "bare":
                    b = a + len(text[a:b].rstrip(_TAIL))
                if b - a >= SHORTEST:
                    found.add((a, b))
    return sorted(found)


def plain_letters(value: str) -> str:
    """The value lowered, and with digits and signs for the letters that they look like; as long as it is."""
    low = value.lower()
    return "".join(LEET.get(c, c) for c in (low if len(low) == len(value) else value))


def pieces(value: str) -> Iterator[str]:
    """Runs of letters in a value that may be words."""
    low = value.lower()
    for form in {plain_letters(value), low if len(low) == len(value) else value}:
        for m in _LETTERS.finditer(form):
            run = m[0]
            for a in range(len(run)):
                for b in range(a + WORD_LENGTHS[0], min(a + WORD_LENGTHS[1], len(run)) + 1):
                    yield run[a:b]


def _choices(n: int, k: int) -> float:
    """Ways to change up to ``k`` of ``n`` characters, as a logarithm."""
    return math.log10(sum(math.comb(n, i) for i in range(1, min(k, n - k) + 1)) or 1)


def _spelling(source: str) -> float:
    """What capitals and look-alikes in a word add."""
    upper, letters = sum(c.isupper() for c in source), sum(c.isalpha() for c in source)
    out = math.log10(2) * len({c for c in source if c in LEET})
    if upper:
        out += math.log10(2) if upper == letters or upper == 1 and source[0].isupper() else _choices(letters, upper) + math.log10(2)
    return out


def _words(value: str, words: dict[str, float]) -> Iterator[tuple[int, int, float]]:
    low = value.lower()
    for form in {plain_letters(value), low if len(low) == len(value) else value}:
        for word, cost in words.items():
            at = form.find(word)
            while at >= 0:
                yield at, at + len(word), cost + _spelling(value[at : at + len(word)])
                at = form.find(word, at + 1)


def _dates(value: str) -> Iterator[tuple[int, int, float]]:
    far = lambda year: max(abs(year - TODAY), AROUND)
    for m in _DATE.finditer(value):
        year = m["y"] or m["z"]
        year = int(year) if len(year) == 4 else 1900 + int(year) if int(year) > 50 else 2000 + int(year)
        yield *m.span(1), math.log10(365 * far(year)) + (math.log10(4) if m["s"] or m["t"] else 0.0)
    for m in _YEAR.finditer(value):
        yield *m.span(1), math.log10(far(int(m[1])))


def _next_key(a: str, b: str) -> tuple[int, int] | None:
    """The way from one key to another that is beside it."""
    if a in _KEYS and b in _KEYS and a != b:
        (x, y), (z, w) = _KEYS[a], _KEYS[b]
        if abs(x - z) <= 1 and abs(y - w) <= 1:
            return (z > x) - (z < x), w - y
    return None


def _next_letter(a: str, b: str) -> int | None:
    return ord(b) - ord(a) if a.isalpha() and b.isalpha() and abs(ord(a) - ord(b)) == 1 else None


def _walks(value: str) -> Iterator[tuple[int, int, float]]:
    """Longest runs of neighbours, on the keyboard and in the alphabet."""
    keys = [SHIFTED.get(c, c.lower()) for c in value]
    for step in (_next_key, _next_letter):
        a, turns, way = 0, 0, None
        for b in range(1, len(keys) + 1):
            new = step(keys[b - 1], keys[b]) if b < len(keys) else None
            if new is not None:
                turns += way is not None and new != way
                way = new
                continue
            if b - a >= 3:
                yield a, b, math.log10(STARTS * (b - a)) + turns * math.log10(TURNS)
            a, turns, way = b, 0, None


def _brute(c: str) -> float:
    return math.log10(10 if c.isdigit() else 26 if c.isascii() and c.isalpha() else 33 if c.isascii() else 100)


def guess_cost(value: str, words: dict[str, float], repeats: bool = True) -> float:
    """The least number of guesses that finds the value, as a decimal logarithm.

    ``words`` holds the cost of the words that it may contain. Each segment that
    is not brute force costs another factor of two, for being there.
    """
    segments: dict[int, list[tuple[int, float]]] = {}
    for found in (_words(value, words), _dates(value), _walks(value)):
        for a, b, cost in found:
            segments.setdefault(b, []).append((a, cost))
    if repeats:
        for m in _REPEAT.finditer(value):
            if m.end() - m.start() >= 3:
                unit = m[1]
                cost = guess_cost(unit, {w: c for w, c in words.items() if len(w) <= len(unit)}, False)
                segments.setdefault(m.end(), []).append((m.start(), cost + math.log10((m.end() - m.start()) // len(unit))))
    best = [0.0]
    for b, c in enumerate(value, 1):
        least = best[-1] + _brute(c)
        for a, cost in segments.get(b, ()):
            least = min(least, best[a] + cost + math.log10(2))
        best.append(least)
    return best[-1]


def listed(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


_SPAN = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())])
_VALUE = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())])
SCAN = "doc_id long, base array<struct<start: long, kind: int, end: long>>, base_sha256 string, found array<struct<start: long, end: long, value: string>>, word string, documents long"
_SCAN = pa.schema([("doc_id", pa.int64()), ("base", pa.list_(_SPAN)), ("base_sha256", pa.string()), ("found", pa.list_(_VALUE)), ("word", pa.string()), ("documents", pa.int64())])


def scanned(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each text with its plain spans and its contexts' values, and rows (word, documents) of each slice of texts."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, SLICE):
            base, digests, found, counts = [], [], [], Counter()
            for t in batch.column(text).to_pylist():
                low = (t := t or "").lower()
                spans, values = base_spans(t, low), contexts(t, low)
                base.append([{"start": a, "kind": KINDS.index(k), "end": b} for k, a, b in spans])
                digests.append(hashlib.sha256(listed(spans).encode()).hexdigest())
                found.append([{"start": a, "end": b, "value": t[a:b]} for a, b in values])
                for a, b in reversed(values):  # a secret is no word, however often it is copied
                    t = f"{t[:a]} {t[b:]}"
                counts.update({w for w in _LETTERS.findall(t.lower() if values else low) if len(w) <= WORD_LENGTHS[1]})
            n, m = batch.num_rows, len(counts)
            own = [batch.column(id), pa.array(base, pa.list_(_SPAN)), pa.array(digests), pa.array(found, pa.list_(_VALUE)), pa.nulls(n, pa.string()), pa.nulls(n, pa.int64())]
            yield pa.RecordBatch.from_arrays(own, schema=_SCAN)
            yield pa.RecordBatch.from_arrays([*(pa.nulls(m, f.type) for f in list(_SCAN)[:4]), pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], schema=_SCAN)

    return docs.select(F.col(id).cast("long").alias(id), text).mapInArrow(scan, SCAN)


def costs(values: DataFrame, words: DataFrame) -> DataFrame:
    """(value, cost) of each distinct value, with counts (word, documents) of the corpus."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "value", SLICE // 64):
            for v in batch.column("value").to_pylist():
                p = sorted(set(pieces(v)))
                yield pa.RecordBatch.from_pydict({"value": pa.array([v] * (len(p) + 1), pa.string()), "word": pa.array([None, *p], pa.string())})

    def guessed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = {w: math.log10(2 + k) for k, w in enumerate(FIRST_GUESSES)}
        for batch in batches:
            out = []
            for v, known in zip(batch.column("value").to_pylist(), batch.column("known").to_pylist()):
                known = {k["word"]: max(0.0, k["cost"]) for k in known}
                low = v.lower()
                out.append(guess_cost(v, known | {w: min(c, known.get(w, c)) for w, c in first.items() if w in low or w in plain_letters(v)}))
            yield pa.RecordBatch.from_arrays([batch.column("value"), pa.array(out, pa.float64())], names=["value", "cost"])

    cuts = settled(values.mapInArrow(cut, "value string, word string"), "secrets-pieces")
    pairs = float(words.agg(F.sum("documents")).first()[0] or 1)
    counted = words.groupBy("word").agg(F.sum("documents").alias("documents")).filter(F.col("documents") >= KNOWN)
    priced = counted.select("word", F.log10(F.lit(pairs) / F.col("documents")).alias("cost"))
    known = F.collect_list(F.when(F.col("cost").isNotNull(), F.struct("word", "cost"))).alias("known")
    return cuts.join(priced, "word", "left").groupBy("value").agg(known).mapInArrow(guessed, "value string, cost double")


def find_spans(docs: DataFrame, least: float = COSTLY, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, base_sha256, spans) of every text; spans are (start, kind, end, cost), kind by its place in ``KINDS``, cost of values alone."""
    small_batches(docs.sparkSession)
    scan = settled(scanned(docs, id, text).withColumn("row", F.monotonically_increasing_id()), "secrets-scan")
    rows = scan.filter("base IS NOT NULL").select(F.col("doc_id").alias(id), "base", "base_sha256", "found", "row")
    places = rows.select("row", F.explode("found").alias("v")).select("row", "v.*")
    words = scan.filter("word IS NOT NULL").select("word", "documents")
    costly = costs(places.select("value").distinct(), words).filter(F.col("cost") >= least)
    salted = costly.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    hits = places.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS))).join(salted, ["value", "salt"])
    kind = F.lit(KINDS.index("value")).alias("kind")
    more = hits.groupBy("row").agg(F.collect_list(F.struct("start", kind, "end", "cost")).alias("more"))
    plain = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), F.lit(None).cast("double").alias("cost")))
    with_values = rows.filter(F.size("found") > 0).join(more, "row", "left")
    both = with_values.withColumn("spans", F.array_sort(F.concat(plain, F.coalesce("more", F.array().cast("array<struct<start: long, kind: int, end: long, cost: double>>")))))
    return both.select(id, "base_sha256", "spans").unionByName(rows.filter(F.size("found") == 0).select(id, "base_sha256", plain.alias("spans")))


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) of every text.

    Counts and ``base_sha256`` are of plain spans, ``spans`` lists all.
    """
    found = find_spans(docs)
    number = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == KINDS.index(k))).cast("long").alias(f"n_{k}")
    names = F.array(*(F.lit(k) for k in KINDS))
    text = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")
    return found.select("doc_id", *(number(k) for k in BASE), "base_sha256", text.alias("spans"))
