"""URL filters: a trie over reversed host labels and path segments, longest match wins.

The trie is sent to the executors with the task, so its size is checked. Beyond ``TRIE_RULES`` rules or
``TRIE_BYTES`` the rules are dealt to shards by their host (those of a host with very many by their path
too), each small enough for a trie in a task. A URL goes to the shards that hold rules of its host or of a
parent domain, and the longest of their answers counts.
"""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.llm.common import bounded
from cadastra.session import pin, shuffle_partitions

TRIE_RULES = 100_000
TRIE_BYTES = 16 << 20
HOST = r"://([^/?#]*)"
PATH = r"(?s)^.*?://[^/?#]*([^?#]*)"


def host_of(url: Column) -> Column:
    """After the first :// up to /, ? or #, A-Z lower-cased; empty for null or without ://."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), HOST, 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host, up to ? or #."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), PATH, 1)


def _segments(path: str) -> list[str]:
    """'/a/b' -> ['/', 'a/', 'b']: complete segments keep their slash, the rest is a prefix."""
    parts = path.split("/")
    return [p + "/" for p in parts[:-1]] + ([parts[-1]] if parts[-1] else [])


def build_trie(rules: Iterable[tuple[str, str, str]]) -> dict:
    """Nested dicts from (verdict, host, path) rules. A node holds its labels under 'hosts', and
    the path trie of rules that end there under 'paths'. Of two verdicts for one rule, block wins.
    """
    root: dict = {"hosts": {}, "paths": None}
    for verdict, host, path in rules:
        node = root
        for label in reversed(host.split(".")):
            node = node["hosts"].setdefault(label, {"hosts": {}, "paths": None})
        if node["paths"] is None:
            node["paths"] = {"next": {}, "open": {}, "end": None}
        place = node["paths"]
        rule = (host + path, verdict)
        pieces = _segments(path)
        for piece in pieces[:-1] if pieces and not pieces[-1].endswith("/") else pieces:
            place = place["next"].setdefault(piece, {"next": {}, "open": {}, "end": None})
        if pieces and not pieces[-1].endswith("/"):
            old = place["open"].get(pieces[-1])
            place["open"][pieces[-1]] = rule if old is None or verdict == "block" else old
        elif place["end"] is None or verdict == "block":
            place["end"] = rule
    return root


def _longest_path(paths: dict, path: str) -> tuple[str, str] | None:
    best, place = None, paths
    for piece in [*_segments(path), ""]:
        best = place["end"] or best
        matches = [k for k in place["open"] if piece.startswith(k)]
        if matches:
            best = place["open"][max(matches, key=len)]
        place = place["next"].get(piece)
        if place is None:
            break
    return best


def match(trie: dict, host: str, path: str) -> tuple[str, str] | None:
    """(rule, verdict) of the longest rule: the deepest host first, then the longest path."""
    best, node = None, trie
    if not host:
        return None
    for label in reversed(host.split(".")):
        node = node["hosts"].get(label)
        if node is None:
            break
        if node["paths"] is not None:
            best = _longest_path(node["paths"], path) or best
    return best


HITS = "host string, path string, host_length int, path_length int, rule string, verdict string"


def _judged(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
    """The hits of a task's rows (shard, verdict, host, path): of each shard the rules, then the URLs."""
    names = HITS.replace("int", "").replace("string", "").replace(" ", "").split(",")
    kinds = [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string()]
    shard, rules, trie = None, [], None
    for batch in batches:
        found = []
        for at, verdict, host, path in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if at != shard:
                shard, rules, trie = at, [], None
            if verdict is not None:
                rules.append((verdict, host, path))
                continue
            if trie is None:
                trie, rules = build_trie(rules), []
            hit = match(trie, host, path)
            if hit:
                cut = len(hit[0].partition("/")[0])
                found.append((host, path, cut, len(hit[0]) - cut, *hit))
        columns = list(zip(*found, strict=True)) or [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _by_shards(keys: DataFrame, rules: DataFrame, trie_bytes: int) -> DataFrame:
    """host, path and __llm_hit (rule, verdict) of the distinct URLs ``keys`` (host, path) that a rule fits.

    A shard holds about ``trie_bytes`` of rules. A host whose rules are more is cut into chunks by their
    paths, each asked by all URLs below it. Shards that many URLs ask are given to several tasks.
    """
    spark = keys.sparkSession
    rules = pin(rules)
    weight = F.sum(F.octet_length("host") + F.octet_length("path") + 16)
    hosts = pin(
        rules.groupBy("host").agg(weight.alias("bytes")).select(
            F.col("host").alias("suffix"), "bytes", F.size(F.split("host", "\\.", -1)).alias("labels"),
            F.ceil(F.col("bytes") / trie_bytes).cast("int").alias("chunks"),
        )
    )
    total, deepest = hosts.agg(F.sum("bytes"), F.max("labels")).first()
    shards = 2 * -(-total // trie_bytes)
    shard = lambda host, chunk: F.pmod(F.xxhash64(host, chunk), F.lit(shards))
    held = rules.join(hosts, rules["host"] == hosts["suffix"]).select(
        shard(F.col("host"), F.pmod(F.xxhash64("path"), F.col("chunks")).cast("int")).alias("shard"), "verdict", "host", "path"
    )
    labels = F.split("host", "\\.", -1)
    ends = F.transform(
        F.sequence(F.lit(1), F.least(F.size(labels), F.lit(deepest))),
        lambda n: F.array_join(F.slice(labels, F.size(labels) - n + 1, n), "."),
    )
    asked = (
        keys.select("host").distinct().select("host", F.explode(ends).alias("suffix"))
        .join(hosts.select("suffix", "chunks"), "suffix")
        .select("host", "suffix", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
        .select("host", shard(F.col("suffix"), F.col("chunk")).alias("shard")).distinct()
    )
    routed = pin(keys.join(asked, "host").select("shard", "host", "path"))
    # One row per shard; a shard fills as many tasks as its URLs fill even shares.
    counts = {r["shard"]: r["n"] for r in routed.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    share = max(1, sum(counts.values()) // shuffle_partitions(spark))
    rows, tasks = [], 0
    for number, n in sorted(counts.items()):
        rows.append((number, tasks, -(-n // share)))
        tasks += rows[-1][2]
    places = pin(spark.createDataFrame(rows, "shard long, first int, copies int"))
    salt = F.pmod(F.xxhash64("host", "path"), F.col("copies")).cast("int")
    copies = F.explode(F.sequence(F.col("first"), F.col("first") + F.col("copies") - 1))
    told = held.join(places, "shard").select(copies.alias("at"), "verdict", "host", "path")
    urls = routed.join(places, "shard").select(
        (F.col("first") + salt).alias("at"), F.lit(None).cast("string").alias("verdict"), "host", "path"
    )
    dealt = told.unionByName(urls).repartitionById(max(1, tasks), F.col("at"))
    # Rules first: a URL has no verdict yet.
    hits = bounded(dealt.sortWithinPartitions("at", F.col("verdict").isNull())).mapInArrow(_judged, HITS)
    best = F.max_by(F.struct("rule", "verdict"), F.struct("host_length", "path_length"))
    return hits.groupBy("host", "path").agg(best.alias("__llm_hit"))


def judge(
    pages: DataFrame,
    rules: list[tuple[str, str, str]] | DataFrame,
    url: str = "url",
    default: str = "allow",
    most: int = TRIE_RULES,
    most_bytes: int = TRIE_BYTES,
) -> DataFrame:
    """Add host, path, rule and verdict to ``pages``. ``rules``: (verdict, host, path), as a list
    or a table with these columns.

    A rule fits its host and all subdomains if the path starts with the rule's. The longest wins:
    most host labels, then the longest path, block before allow. Without a rule the verdict is
    ``default``. A null URL, or one without ://, has an empty host and path, which no rule fits.
    A rule with a null fits nothing. Existing columns named like the four are replaced; repeated rows stay.
    Empty table: no rows. Tables of more than ``most`` rules or ``most_bytes`` are dealt to shards.
    """
    parted = pages.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    if isinstance(rules, DataFrame):
        whole = rules.select("verdict", "host", "path").dropna().distinct()
        count, size = whole.agg(F.count("*"), F.sum(F.octet_length("host") + F.octet_length("path") + 16)).first()
        if count > most or (size or 0) > most_bytes:
            hits = _by_shards(parted.filter("host <> ''").select("host", "path").distinct(), whole, most_bytes)
            joined = parted.join(hits, ["host", "path"], "left")
            return joined.withColumns(
                {"rule": F.col("__llm_hit.rule"), "verdict": F.coalesce("__llm_hit.verdict", F.lit(default))}
            ).drop("__llm_hit")
        rules = [tuple(r) for r in whole.collect()]
    rules = [r for r in rules if None not in r]
    trie = pages.sparkSession.sparkContext.broadcast(build_trie(rules))

    @F.pandas_udf("struct<rule: string, verdict: string>")
    def decide(host: pd.Series, path: pd.Series) -> pd.DataFrame:
        hits = [match(trie.value, h, p) or (None, default) for h, p in zip(host, path, strict=True)]
        return pd.DataFrame(hits, columns=["rule", "verdict"])

    marked = parted.withColumn("__llm_hit", decide("host", "path"))
    return marked.withColumns({"rule": F.col("__llm_hit.rule"), "verdict": F.col("__llm_hit.verdict")}).drop("__llm_hit")
