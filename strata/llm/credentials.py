"""Secret scans by multipart credential linking.

Strong patterns (a keyed value of 12 or more characters, an access key id, a long hex run) are findings
by themselves. Weaker parts are only candidates: short keyed secrets, random-looking tokens, user and
client names, hosts and addresses. Each text is cut into scopes at blank lines; within a scope every
secret is joined to the identifiers and endpoints whose intervals lie within ``REACH`` characters of its
own, and a weak candidate is reported only where parts that complement it are found.

Parts of a kind do not overlap, so their starts and ends are both sorted and the interval join is a
binary search per secret for the nearest partner: n parts cost n log n, however many share a scope.
Everything happens inside the task that holds the text; nothing is shuffled.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .registry import query

#: Farthest gap, in code points, between the parts of one credential.
REACH = 400
#: Shortest values: of a strong keyed secret, and of a weak one.
STRONG_VALUE, WEAK_VALUE = 12, 6
#: Kinds in the order in which findings with the same start are listed; the first three are strong.
KINDS = ("assign", "access", "hex", "identifier", "secret", "endpoint")
STRONG = KINDS[:3]

_GIVES = r"""["']?\x20*[:=]\x20*["']?"""
_CASELESS = re.ASCII | re.IGNORECASE
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)" + _GIVES + r"([A-Za-z0-9+/_.=-]+)", _CASELESS)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
_NAMED_ID = r"(?<![A-Za-z])(?:user(?:_?name)?|login|account(?:_?id)?|client_?id|access_?key(?:_?id)?|key_?id)"
IDENTIFIER = re.compile(_NAMED_ID + _GIVES + r"[A-Za-z0-9@+/_.-]{2,}", _CASELESS)
_NAMED_SECRET = r"(?<![A-Za-z])(?:pwd|pass|passphrase|credential|client_?key|private_?key|auth)"
KEYED = re.compile(_NAMED_SECRET + _GIVES + r"[A-Za-z0-9+/_.=!@#$%^&*-]{6,}", _CASELESS)
RANDOM = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{20,}={0,2}")
URL = re.compile(r"""(?<![A-Za-z0-9+.-])[A-Za-z][A-Za-z0-9+.-]*://[^\s"'<>]+""", re.ASCII)
_NAMED_HOST = r"(?<![A-Za-z])(?:host(?:_?name)?|server|endpoint|bucket|database)"
HOST = re.compile(_NAMED_HOST + _GIVES + r"[A-Za-z0-9_.:/-]{2,}", _CASELESS)
ADDRESS = re.compile(r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?::[0-9]{1,5})?(?![0-9.]*[0-9])")
BLANK_LINE = re.compile(r"\n[ \t\r]*\n")

Span = tuple[int, int]


class Finding(NamedTuple):
    kind: str
    start: int
    end: int


class Credential(NamedTuple):
    """Starts of the parts of one credential (null: no such part near)."""

    secret: int
    identifier: int | None
    endpoint: int | None


class Intervals:
    """Disjoint spans in order: the earliest first, and none that overlaps one taken before or an ``avoid`` one."""

    def __init__(self, spans: list[Span], avoid: Intervals | None = None):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for a, b in sorted(spans, key=lambda s: (s[0], -s[1])):
            if (not self.ends or a >= self.ends[-1]) and not (avoid and avoid.meets(a, b)):
                self.starts.append(a)
                self.ends.append(b)

    def spans(self) -> list[Span]:
        return list(zip(self.starts, self.ends, strict=True))

    def meets(self, a: int, b: int) -> bool:
        i = bisect_right(self.ends, a)
        return i < len(self.starts) and self.starts[i] < b

    def nearest(self, a: int, b: int, low: int, high: int) -> Span | None:
        """The interval with the smallest gap to [a, b) among those that lie in [low, high) in whole and
        within ``REACH``; the earlier of two as near."""
        i = bisect_left(self.ends, b)  # the first that ends behind b's last place: the next one, or one around
        best = None
        for k in (i - 1, i, i + 1):
            if 0 <= k < len(self.starts):
                s, e = self.starts[k], self.ends[k]
                gap = max(a - e, s - b, 0)
                if low <= s and e <= high and gap <= REACH and (best is None or gap < best[0]):
                    best = (gap, (s, e))
        return best and best[1]


def _random_looking(token: str) -> bool:
    return any(c.islower() for c in token) and any(c.isupper() for c in token) and any(c.isdigit() for c in token)


def scan(text: str) -> tuple[list[Finding], list[Credential]]:
    """Findings of a whole text by start and kind, and the credentials that link them."""
    keyed = ":" in text or "=" in text  # without either no keyed part and no URL can match
    assign = list(ASSIGN.finditer(text)) if keyed else []
    strong = [Finding("assign", *m.span()) for m in assign if m.end(2) - m.start(2) >= STRONG_VALUE]
    access = [m.span() for m in ACCESS.finditer(text)]
    strong += [Finding("access", *s) for s in access] + [Finding("hex", *m.span()) for m in HEX.finditer(text)]
    if not keyed and not access:  # every rule below needs a keyed part or an access key id
        return sorted(strong, key=_order), []

    base = Intervals([(f.start, f.end) for f in strong if f.kind != "hex"])
    identifiers = Intervals(access + [s for s in _spans(IDENTIFIER, text) if not base.meets(*s)])
    short = [m.span() for m in assign if WEAK_VALUE <= m.end(2) - m.start(2) < STRONG_VALUE]
    weak = Intervals(short + _spans(KEYED, text), base)
    named = Intervals(_spans(URL, text) + _spans(HOST, text))
    secrets = [(f.start, f.end, "assign") for f in strong if f.kind == "assign"] + [(*s, "secret") for s in weak.spans()]
    numbers = Intervals([])
    if identifiers.starts:  # alone, neither a random token nor an address makes a credential
        numbers = Intervals(_spans(ADDRESS, text), named)
        hexes = Intervals([(f.start, f.end) for f in strong if f.kind == "hex"], base)
        tokens = [s for s in _spans(RANDOM, text) if _random_looking(text[s[0] : s[1]])]
        tokens = [s for s in tokens if not any(x.meets(*s) for x in (base, hexes, identifiers, weak, named))]
        secrets += [(*s, "random") for s in tokens]
    keys = Intervals(access)

    blank = [m.span() for m in BLANK_LINE.finditer(text)]
    begins, ends = [0, *(b for _, b in blank)], [*(a for a, _ in blank), len(text)]
    found, credentials = set(strong), []
    for a, b, kind in secrets:
        k = bisect_right(begins, a) - 1
        scope = begins[k], ends[k]
        who, where = identifiers.nearest(a, b, *scope), named.nearest(a, b, *scope)
        if who and not where:
            where = numbers.nearest(a, b, *scope)
        if kind == "random":
            complete = (who and where) or keys.nearest(a, b, *scope)
        else:
            complete = who or where
        if not complete:
            continue
        if kind != "assign":
            found.add(Finding("secret", a, b))
        if who and not keys.meets(*who):
            found.add(Finding("identifier", *who))
        if where:
            found.add(Finding("endpoint", *where))
        credentials.append(Credential(a, who and who[0], where and where[0]))
    return sorted(found, key=_order), sorted(credentials)


def _order(f: Finding) -> tuple[int, int, int]:
    return f.start, KINDS.index(f.kind), f.end


def _spans(pattern: re.Pattern, text: str) -> list[Span]:
    return [m.span() for m in pattern.finditer(text)]


SCAN = "struct<findings:array<struct<kind:string,start:long,end:long>>,credentials:array<struct<secret:long,identifier:long,endpoint:long>>>"
_FINDING = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
_CREDENTIAL = pa.struct([("secret", pa.int64()), ("identifier", pa.int64()), ("endpoint", pa.int64())])


def _scan_column(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for col in batches:
        findings, credentials = [], []
        for text in col:
            f, c = scan(text.as_py() or "")
            findings.append([x._asdict() for x in f])
            credentials.append([x._asdict() for x in c])
        parts = [pa.array(findings, pa.list_(_FINDING)), pa.array(credentials, pa.list_(_CREDENTIAL))]
        yield pa.StructArray.from_arrays(parts, names=["findings", "credentials"])


def find_secrets(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """The input rows with ``findings`` and ``credentials``.

    ``findings``: array of (kind, start, end) in code points, end exclusive, by start, then kind in the order
    of ``KINDS``. Strong kinds are always listed: ``assign`` (a password, secret, token or API key with a
    value of 12 or more characters), ``access`` (``AKIA`` ids of 18 or more), ``hex`` (runs of 16 or more); of
    each kind the leftmost matches that do not overlap. ``identifier``, ``secret`` and ``endpoint`` are weak
    kinds, listed where a credential is complete: a keyed secret with an identifier or a named endpoint; a
    random-looking token with an access key id, or with an identifier and an endpoint; a plain address only
    beside an identifier. ``credentials``: array of (secret, identifier, endpoint) starts, the nearest partners of
    every completed secret.

    Defined cases: null and empty texts have no findings; a part belongs to the scope (text between
    blank lines) that it starts in, and partners must lie in that scope in whole; equal rows give equal
    rows; an empty table gives no rows; input columns with the names of the output's are replaced.
    """
    names = [c for c in docs.columns if c not in ("findings", "credentials")]
    mark = common.free("scan", docs.columns)
    # Marked so that Spark runs it once for both columns.
    scanned = F.arrow_udf(_scan_column, SCAN).asNondeterministic()
    kept = docs.select(*[F.col(f"`{c}`") for c in names], scanned(F.col(f"`{text_col}`").cast("string")).alias(mark))
    return kept.select(*[F.col(f"`{c}`") for c in names], F.col(f"{mark}.findings"), F.col(f"{mark}.credentials"))


def _listed(findings) -> F.Column:
    return F.array_join(F.transform(findings, lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])), ",")


@query("op11_secret_scan")
def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    count = lambda kind: F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("long")
    return find_secrets(docs).select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in STRONG],
        F.sha2(_listed(F.filter("findings", lambda f: f["kind"].isin(*STRONG))), 256).alias("base_sha256"),
        _listed(F.col("findings")).alias("spans"),
        F.size("credentials").cast("long").alias("n_credentials"),
    )
