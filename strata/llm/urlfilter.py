"""URL filters by a sorted digest array.

Rules (host, path prefix, verdict) become 64-bit xxhash keys of host + path, sorted
and stored in segments: Spark range-partitions the digests, every task writes one
segment (keys, string offsets, strings, verdicts) into the shared folder, and the
driver keeps only the segment names with their first and last key. Probing tasks map
the segments into memory, look candidate keys up by vectorised binary search and
confirm each hit against the stored string, so a collision never decides.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import scratch_path

from . import common
from .registry import query

SEED = 0
RULES_PER_SEGMENT = 2_000_000
_PARTS = ("keys", "first", "text", "block")


@dataclass(frozen=True)
class DigestArray:
    """Where the segments lie. ``segments`` holds (name, first key, last key); there is
    one per ``RULES_PER_SEGMENT`` rules. ``lengths`` are the distinct path lengths."""

    path: str
    segments: tuple[tuple[str, int, int], ...]
    lengths: tuple[int, ...]


def digest(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode(), SEED)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _write(fs: pafs.FileSystem, path: str, data: bytes) -> None:
    """Write beside the target, then move: a retried task leaves one whole file."""
    part = f"{path}.{os.getpid()}.{os.urandom(4).hex()}"
    with fs.open_output_stream(part) as out:
        out.write(data)
    fs.move(part, path)


def build_digest_array(rules: DataFrame, path: str | None = None, rules_per_segment: int = RULES_PER_SEGMENT) -> DigestArray:
    """Store a (host, path, verdict) table as a sorted digest array.

    Hosts are lower-cased (A-Z); rules with a null host or path, an empty host or a verdict
    other than allow / block are left out; a rule given twice counts once, and block wins
    over allow. ``path`` defaults to a fresh folder under the shared scratch root.
    """
    spark = rules.sparkSession
    path = path or scratch_path(spark, "digests")
    host = common.ascii_lower(F.col("host"))
    rows = (
        rules.filter("host is not null and host <> '' and path is not null and verdict in ('allow', 'block')")
        .select(F.concat(host, F.col("path")).alias("text"), host.alias("host"), F.col("path").alias("p"), "verdict")
        .groupBy("text")
        .agg(F.max("verdict").alias("verdict"), F.collect_set(F.length("p")).alias("lens"))
    )

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            d = pa.array([_signed(digest(t) ^ 1 << 63) for t in b.column("text").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([d, b.column("text"), b.column("verdict"), b.column("lens")], names=["d", "text", "verdict", "lens"])

    rows = common.cut(rows.mapInArrow(hashed, "d long, text string, verdict string, lens array<int>"))
    n = rows.count()
    if not n:
        return DigestArray(path, (), ())

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(list(batches), schema=pa.schema([("d", pa.int64()), ("text", pa.string()), ("verdict", pa.string())]))
        if not t.num_rows:
            return
        keys = t.column("d").to_numpy().astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)
        texts = [x.encode() for x in t.column("text").to_pylist()]
        first = np.concatenate([[0], np.cumsum([len(x) for x in texts])]).astype(np.int64)
        block = np.array([v == "block" for v in t.column("verdict").to_pylist()], dtype=np.uint8)
        fs, base = pafs.FileSystem.from_uri(path)
        fs.create_dir(base, recursive=True)
        name = f"{int(keys[0]):016x}"
        for part, data in zip(_PARTS, (keys.tobytes(), first.tobytes(), b"".join(texts), block.tobytes()), strict=True):
            _write(fs, f"{base}/{name}.{part}", data)
        yield pa.RecordBatch.from_pydict({"name": [name], "lo": [str(int(keys[0]))], "hi": [str(int(keys[-1]))]})

    parts = max(1, -(-n // rules_per_segment))
    dealt = rows.select("d", "text", "verdict").repartitionByRange(parts, "d").sortWithinPartitions("d", "text")
    made = dealt.mapInArrow(store, "name string, lo string, hi string").collect()  # one row per segment
    lengths = sorted(r[0] for r in rows.select(F.explode("lens")).distinct().collect())
    return DigestArray(path, tuple(sorted(((r["name"], int(r["lo"]), int(r["hi"])) for r in made), key=lambda s: s[1])), tuple(lengths))


class Prober:
    """The segments of a digest array, mapped on first use (one per task)."""

    def __init__(self, array: DigestArray):
        self.array, self.open = array, {}

    def _map(self, name: str) -> dict[str, np.ndarray]:
        if name not in self.open:
            fs, base = pafs.FileSystem.from_uri(self.array.path)
            got = {}
            for part, kind in zip(_PARTS, (np.uint64, np.int64, np.uint8, np.uint8), strict=True):
                file = f"{base}/{name}.{part}"
                if not isinstance(fs, pafs.LocalFileSystem):  # a remote store: fetch once, then map the copy
                    with tempfile.NamedTemporaryFile(delete=False) as copy, fs.open_input_stream(file) as src:
                        while chunk := src.read(1 << 22):
                            copy.write(chunk)
                    file, temp = copy.name, copy.name
                else:
                    temp = None
                got[part] = np.memmap(file, dtype=kind, mode="r") if os.path.getsize(file) else np.zeros(0, kind)
                if temp:
                    os.unlink(temp)  # the mapping keeps the data
            self.open[name] = got
        return self.open[name]

    def probe(self, texts: list[str]) -> np.ndarray:
        """Per text -1 (absent), 0 (allow) or 1 (block)."""
        out = np.full(len(texts), -1, dtype=np.int8)
        if not texts or not self.array.segments:
            return out
        raw = [t.encode() for t in texts]
        want = np.fromiter((xxhash.xxh64_intdigest(t, SEED) for t in raw), np.uint64, len(raw))
        lows = np.array([s[1] for s in self.array.segments], dtype=np.uint64)
        seg = np.searchsorted(lows, want, side="right") - 1
        for k in np.unique(seg[seg >= 0]):
            # equal keys may straddle a boundary: look into the segment before as well
            for j in (k, k - 1) if k and lows[k] == self.array.segments[k - 1][2] else (k,):
                s = self._map(self.array.segments[j][0])
                rows = np.flatnonzero(seg == k)
                at = np.searchsorted(s["keys"], want[rows])
                inside = at < len(s["keys"])
                hit = inside.copy()
                hit[inside] = s["keys"][at[inside]] == want[rows[inside]]
                for r, a in zip(rows[hit], at[hit], strict=True):
                    while a < len(s["keys"]) and s["keys"][a] == want[r]:
                        if s["text"][s["first"][a] : s["first"][a + 1]].tobytes() == raw[r]:
                            out[r] = s["block"][a]
                        a += 1
        return out


def judge(urls: DataFrame, array: DigestArray, url_col: str = "url", default: str = "allow") -> DataFrame:
    """The input rows with ``host``, ``path``, ``rule`` and ``verdict``.

    Host: after the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; path: from there
    up to ``? #`` or the end; a null url or one without ``://`` has both empty. A rule fits its host
    and all subdomains when the path starts with the rule's; the longest rule wins, of
    equally long ones the longer host. ``default`` is the verdict of a url that no stored rule fits
    (the array holds what is listed, so an absent url is allowed unless told otherwise).
    Input columns named like an output column are replaced; an empty table gives no rows.
    """
    names = [c for c in urls.columns if c not in ("host", "path", "rule", "verdict")]
    split = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    url = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    held, back = common.set_aside(names)
    parsed = urls.select(*held, common.ascii_lower(F.regexp_extract(url, split, 1)).alias("host"), F.regexp_extract(url, split, 2).alias("path"))
    lengths = array.lengths

    @F.pandas_udf("rule string, verdict string")
    def match(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        prober = Prober(array)
        for hosts, paths in batches:
            owner, texts, weight = [], [], []
            for i, (h, p) in enumerate(zip(hosts, paths, strict=True)):
                at = 0
                while h and at >= 0:
                    suffix = h[at:]
                    for n in lengths:
                        if n > len(p):
                            break
                        owner.append(i)
                        texts.append(suffix + p[:n])
                        weight.append((len(suffix) + n, len(suffix)))
                    at = h.find(".", at) + 1 or -1
            found = prober.probe(texts)
            best: dict[int, int] = {}
            for j in np.flatnonzero(found >= 0):
                i = owner[j]
                if i not in best or weight[j] > weight[best[i]]:
                    best[i] = j
            n = len(hosts)
            yield pd.DataFrame({
                "rule": [texts[best[i]] if i in best else None for i in range(n)],
                "verdict": [("block" if found[best[i]] else "allow") if i in best else default for i in range(n)],
            })

    judged = parsed.withColumn("judged", match(F.col("host"), F.col("path")))
    return judged.select(*back, "host", "path", "judged.rule", "judged.verdict")


# The rules of the query: fixed values of its contract.
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]

OP10_SQL = r"""
WITH r(rhost, rpath, rverdict) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
  ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
p AS (SELECT page_id, url, row_number() OVER () AS k,
  translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
m AS (SELECT p.k, r.*, row_number() OVER (PARTITION BY p.k ORDER BY length(rhost || rpath) DESC, length(rhost) DESC) AS n
  FROM p JOIN r ON (p.host = r.rhost OR ends_with(p.host, '.' || r.rhost)) AND starts_with(p.path, r.rpath))
SELECT page_id, host, path, rhost || rpath AS rule, coalesce(rverdict, 'allow') AS verdict
FROM p LEFT JOIN m ON p.k = m.k AND m.n = 1
"""


@query("op10_url_filter", OP10_SQL)
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    pages = common.table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages, build_digest_array(rules)).select("page_id", "host", "path", "rule", "verdict")
