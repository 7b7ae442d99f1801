"""SpotSigs fingerprints: chains of content words after common words, by DataFrame functions only.

A word is a run of letters or digits, lower-cased. At each common word (anchor) the next
``CHAIN`` words that are not common form a chain; anchor and chain are one signature, kept as its
64-bit hash. A document's fingerprint is the set of its signatures. Common words are those a corpus has
most of in each language (``frequent_words``). Where no chain begins for ``GAP`` words or more, and in texts
without any chain, each ``RUN`` consecutive words (common ones included) are a signature; so word lists and
texts in any language have many signatures, and an edit changes only those near it. Without ``run``
(the functions' default) a text without chains is represented by one hash of the words it has.

Near duplicates: two sets with Jaccard likeness of at least t have sizes within a factor of t. Sets
are dealt to partitions by length; the rarest signatures of each set (as many as any likely partner must
share one of) meet in an equality join with the same and the next length partition. Sizes, and the
places of the common signature, prune before sets are compared.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadastra.llm.common import sized
from cadastra.session import pin, shuffle_partitions

CHAIN = 2
LIKENESS = 0.8
RUN = 3
GAP = 20
# Signatures are counted in so many slots, of which the driver gets one number each.
SLOTS = 1 << 16
# A word is common if it is at least this share of the words of a language, and occurs so often.
COMMON_SHARE = 0.005
COMMON_TIMES = 20
# Common words of four languages (a parameter of every function that uses them).
COMMON = (
    "the of and to a in is that for it was on with be as by this are at from "
    "de la le et les des en un du une que pour est qui dans par pas au sur avec "
    "der die und von zu das sich mit auf für ist nicht im dem ein eine als "
    "el y los se del las por no con su es para al lo"
).split()


def words_of(text: Column) -> Column:
    """Lower-cased runs of letters or digits. Null counts as empty."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}\\p{N}]+"), lambda w: w != "")


def frequent_words(docs: DataFrame) -> list[str]:
    """Common words of ``docs`` (text, and lang if there is one), sorted: those with at least
    ``COMMON_SHARE`` of all words of a language and ``COMMON_TIMES`` occurrences there. They hold for every
    text, so that a fingerprint does not depend on the label. At most 1 / COMMON_SHARE a language."""
    lang = F.coalesce(F.col("lang"), F.lit("")) if "lang" in docs.columns else F.lit("")
    each = docs.select(lang.alias("lang"), F.explode(words_of(F.col("text"))).alias("word"))
    counts = pin(each.groupBy("lang", "word").agg(F.count("*").alias("times")))
    totals = pin(counts.groupBy("lang").agg(F.sum("times").alias("total")))
    often = counts.filter(F.col("times") >= COMMON_TIMES).join(sized(totals, totals.count()), "lang")
    found = often.filter(F.col("times") >= F.col("total") * F.lit(COMMON_SHARE)).select("word").distinct()
    return sorted(r["word"] for r in found.collect())


def spot_signatures(text: Column, common: list[str] = COMMON, chain: int = CHAIN, run: int | None = None) -> Column:
    """Sorted distinct signature hashes of a text, an array of long. Null counts as empty, a text
    without words gives no hash. A text without chains gives the hashes of all its runs of ``run``
    words (of all its words, if they are fewer), and so does, in any text, a stretch of ``GAP`` words or
    more at which no chain begins; without ``run`` a text without chains gives one hash of all its words."""
    is_common = lambda w: w.isin(list(common))

    def parts_of(words: Column) -> Column:
        marks = F.filter(
            F.transform(words, lambda w, i: F.when(is_common(w), F.struct(w.alias("w"), i.alias("i")))),
            lambda m: m.isNotNull(),
        )
        content = F.filter(words, lambda w: ~is_common(w))
        return F.struct(words.alias("words"), marks.alias("marks"), content.alias("content"))

    def chains_of(parts: Column) -> Column:
        # The j-th common word stands at i, so i - j content words precede it.
        chains = F.transform(
            parts["marks"],
            lambda m, j: F.struct(
                m["w"].alias("w"), m["i"].alias("i"), F.slice(parts["content"], m["i"] - j + 1, chain).alias("c")
            ),
        )
        full = F.filter(chains, lambda c: F.size(c["c"]) == chain)
        return F.struct(*[parts[k].alias(k) for k in ("words", "marks", "content")], full.alias("full"))

    def of(parts: Column) -> Column:
        hashes = F.transform(parts["full"], lambda c: F.xxhash64(c["w"], F.array_join(c["c"], " ")))
        if run is None:
            return F.when(F.size(hashes) > 0, F.array_sort(F.array_distinct(hashes))).when(
                F.size(parts["words"]) > 0,
                F.array(F.xxhash64(F.array_join(parts["content"], " "), F.size(parts["marks"]))),
            ).otherwise(F.array().cast("array<bigint>"))
        count = F.size(parts["words"])
        ends = F.concat(F.array(F.lit(-1)), F.transform(parts["full"], lambda c: c["i"]), F.array(count))
        # Words first to last - 1 lie between two beginnings of chains.
        gaps = F.zip_with(
            F.slice(ends, F.lit(1), F.size(ends) - 1), F.slice(ends, F.lit(2), F.size(ends) - 1),
            lambda x, y: F.struct((x + 1).alias("first"), y.alias("last")),
        )
        bare = F.filter(
            gaps, lambda g: (g["last"] - g["first"] >= GAP) | ((F.size(parts["full"]) == 0) & (count > 0))
        )
        runs = F.flatten(F.transform(
            bare,
            lambda g: F.transform(
                F.sequence(g["first"], F.greatest(g["first"], g["last"] - run)),
                lambda i: F.xxhash64(F.lit("run"), F.array_join(F.slice(parts["words"], i + 1, run), " ")),
            ),
        ))
        return F.array_sort(F.array_distinct(F.concat(hashes, runs)))

    # transform over one value evaluates it once.
    parts = F.transform(F.array(words_of(text)), parts_of)
    return F.transform(F.transform(parts, chains_of), of)[0]


def jaccard(one: Column, two: Column) -> Column:
    """Likeness of two signature sets; two empty sets are equal (1), an empty and another not (0)."""
    shared = F.size(F.array_intersect(one, two)).cast("double")
    union = F.size(one) + F.size(two) - shared
    return F.when(union == 0, 1.0).otherwise(shared / F.greatest(union, F.lit(1.0)))


def pruned_jaccard(one: Column, two: Column, least: float = LIKENESS) -> Column:
    """Likeness, or null if the sizes alone exclude ``least``."""
    small, large = F.least(F.size(one), F.size(two)), F.greatest(F.size(one), F.size(two))
    return F.when(small >= large * F.lit(least), jaccard(one, two))


def print_of(signatures: Column) -> Column:
    """The fingerprint of a set as text: its size and a digest of its sorted hashes."""
    return F.concat_ws("-", F.size(signatures).cast("string"), F.md5(F.array_join(signatures, ",").cast("binary")))


def next_in_order(docs: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``docs`` with ``columns`` added and ``__llm_next``: a struct of their values in the next row
    in descending doc_id (ties: descending text; null ids last), after the last row the first.
    Null if there is no other row. The columns are computed once per row, after the shuffle.

    Ids are cut into ranges at quantiles; one row of each range, its first, is also sent to the
    range before it. So the texts are shuffled once, and no range needs another.
    """
    spark = docs.sparkSession
    parts = max(2, shuffle_partitions(spark))
    shares = [i / parts for i in range(1, parts)]
    found = docs.agg(F.percentile_approx("doc_id", F.lit(shares), max(10_000, 20 * parts))).first()[0] or []
    cuts = sorted(set(found))
    inner = max(1, math.isqrt(len(cuts)))
    groups = [cuts[i : i + inner] for i in range(0, len(cuts), inner)]
    heads = F.array(*[F.lit(g[0]).cast("long") for g in groups]) if groups else F.array().cast("array<bigint>")
    at = F.lit(0)
    if groups:
        whole = F.size(F.filter(heads, lambda h: h < F.col("doc_id")))
        table = F.array(*[F.array(*[F.lit(v).cast("long") for v in g]) for g in groups])
        fine = F.size(F.filter(F.coalesce(F.try_element_at(table, whole), F.array().cast("array<bigint>")),
                               lambda v: v < F.col("doc_id")))
        at = F.when(whole > 0, (whole - 1) * inner + fine).otherwise(0)
    # Ranges in descending order of ids; null ids come after all others.
    number = F.when(F.col("doc_id").isNull(), F.lit(len(cuts) + 1)).otherwise(F.lit(len(cuts)) - at)
    ranged = docs.withColumn("__llm_range", number.cast("int"))
    # The largest id of every range that has rows: at most one row per range.
    tops = ranged.groupBy("__llm_range").agg(
        F.max(F.coalesce("doc_id", F.lit(-(1 << 63)))).alias("top")
    ).collect()
    if not tops:
        added = docs.withColumns(columns)
        return added.withColumn("__llm_next", F.struct(*columns))
    used = sorted(r["__llm_range"] for r in tops)
    before = {used[i]: used[i - 1] for i in range(len(used))}
    rows = [(r["__llm_range"], r["top"], before[r["__llm_range"]]) for r in tops]
    firsts = spark.createDataFrame(rows, "__llm_of int, __llm_top long, __llm_to int")
    mine = (F.col("__llm_range") == F.col("__llm_of")) & (
        F.coalesce("doc_id", F.lit(-(1 << 63))) == F.col("__llm_top")
    )
    marked = ranged.join(F.broadcast(firsts), mine, "left")
    homes = F.array(F.struct(F.col("__llm_range").alias("r"), F.lit(False).alias("guest")))
    guest = F.array(F.struct(F.col("__llm_to").alias("r"), F.lit(True).alias("guest")))
    sent = marked.withColumn(
        "__llm_home", F.explode(F.when(F.col("__llm_to").isNotNull(), F.concat(homes, guest)).otherwise(homes))
    ).select(*docs.columns, "__llm_home.r", "__llm_home.guest")
    order = Window.partitionBy("r").orderBy(
        "guest", F.col("doc_id").desc_nulls_last(), F.col("text").desc_nulls_last()
    )
    # Each range in a task of its own: a hash of its number would put several together.
    dealt = sent.repartitionById(len(cuts) + 2, F.col("r")).withColumns(columns)
    shown = dealt.withColumn("__llm_next", F.lead(F.struct(*columns)).over(order))
    return shown.filter(~F.col("guest")).drop("r", "guest")


def compare_edits(
    docs: DataFrame, common: list[str] = COMMON, chain: int = CHAIN, run: int | None = None
) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): n_chars, sha256 of its edited text, the fingerprints of
    both, and the likeness of its signatures to the edited text's and to the next document's.

    Edited: the last third (floor) of the code points is replaced by the first as many of the next
    document in descending doc_id, or all of it if it has fewer; after the last comes the first.
    Null text counts as empty. A single row is its own next. Other columns are ignored. Empty
    table: no rows.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    own = {"body": F.col("text"), "mine": spot_signatures(F.col("text"), common, chain, run)}
    rows = next_in_order(texts, own)
    third = F.floor(F.col("n_chars") / 3).cast("int")
    # A single row has no other row to be shown.
    following = F.coalesce(F.col("__llm_next.body"), F.col("text"))
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - third),
        F.substring(following, F.lit(1), third),
    )
    built = rows.withColumn("n_chars", F.length("text").cast("long")).select(
        "doc_id", "n_chars", "mine", F.coalesce("__llm_next.mine", "mine").alias("after"), edited.alias("edited")
    )
    signed = built.select(
        "doc_id", "n_chars", "mine", "after",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        spot_signatures(F.col("edited"), common, chain, run).alias("other"),
    )
    return signed.select(
        "doc_id", "n_chars", "edited_sha256",
        print_of(F.col("mine")).alias("fingerprint"), print_of(F.col("other")).alias("edited_fingerprint"),
        jaccard(F.col("mine"), F.col("other")).alias("near_edited"),
        jaccard(F.col("mine"), F.col("after")).alias("near_next"),
    )


def _slots(signed: DataFrame) -> list[int]:
    """How often the signatures of each of ``SLOTS`` slots occur, as twice the binary logarithm (below 128)."""
    slot = F.pmod(F.col("hash"), F.lit(SLOTS)).cast("int")
    times = signed.select(F.explode("set").alias("hash")).groupBy(slot.alias("slot")).agg(F.count("*").alias("n"))
    found = {r["slot"]: r["n"] for r in times.collect()}
    return [int(2 * math.log2(found.get(i, 1))) for i in range(SLOTS)]


def _first(n: Column, share: float) -> Column:
    """How many of the first of ``n`` signatures hold one of any ``share`` of them."""
    return (n - F.ceil(n * F.lit(share) - 1e-9) + 1).cast("int")


def near_classes(
    docs: DataFrame, least: float = LIKENESS, common: list[str] = COMMON, chain: int = CHAIN, run: int | None = None,
    asked: Column | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(members, classes, pairs) of ``docs`` (doc_id, text). Rows with the same signature set form a class.

    members: doc_id and class_id of every row. classes: fingerprint, class_id (the smallest id), links (how many
    other classes are near). pairs: a, b (class ids, a < b) and likeness of all classes whose sets have a
    likeness of at least ``least``. With ``asked``, a condition on doc_id, only classes with such a row are
    looked up, against all; other classes have NULL links and meet in no pair.

    Empty sets (null and empty texts, texts without words) form a class without links. Repeated rows are in
    one class. Rows without an id have a class, but a class of such rows alone has no id and no links. Rows that
    share an id and differ in text are in several classes of that id; these are not linked to each other,
    and others are linked to the likest. Other columns are ignored. Empty table: no rows.

    A text's signatures are ordered by how often their slot occurs in all texts, rarest first. If two sets are
    near, the first of the smaller (those left when the least overlap is taken off, and one) share one with the
    first of the larger. So a signature that many texts have is looked up only where a text has hardly any
    other, and a signature met late in both sets shows that the rest cannot suffice.
    """
    signed = pin(
        docs.select("doc_id", spot_signatures(F.col("text"), common, chain, run).alias("set"))
        .withColumn("fingerprint", print_of(F.col("set")))
    )
    ranks = F.split(F.lit(",".join(map(str, _slots(signed)))), ",").cast("array<bigint>")
    # The rank of the slot, then the upper 56 bits: equal signatures give equal tokens.
    tokens = F.array_sort(F.transform("set", lambda h: F.shiftleft(
        F.get(ranks, F.pmod(h, F.lit(SLOTS)).cast("int")), 56).bitwiseOR(F.shiftrightunsigned(h, 8))))
    wish = F.lit(True) if asked is None else F.coalesce(asked, F.lit(False))
    # A class takes the first tokens of its smallest id along, so that sets are not shuffled for it.
    ordered = signed.select("doc_id", "fingerprint", F.size("set").alias("n"), tokens.alias("tokens"))
    n = F.col("n")
    classes = pin(
        ordered.select("doc_id", "fingerprint", wish.alias("asked"), "n", F.slice("tokens", F.lit(1), _first(n, least)).alias("tokens"))
        .groupBy("fingerprint").agg(
            F.min("doc_id").alias("class_id"), F.max("asked").alias("asked"), F.max("n").alias("n"),
            F.min_by("tokens", "doc_id").alias("tokens"),
        )
    )
    members = signed.select("doc_id", "fingerprint").join(classes, "fingerprint").select("doc_id", "class_id")
    # Length partition: sizes up to a factor 1/least share one or neighbour.
    band = F.floor(F.log(n.cast("double")) / F.lit(-math.log(least)) + 1e-9)
    reps = classes.filter("class_id IS NOT NULL AND n > 0").select(
        F.col("class_id").alias("id"), "n", band.cast("int").alias("band"), "tokens", "asked")
    key = F.xxhash64(F.col("at_band"), F.col("token"))
    place = F.shiftleft(n.cast("long"), 32).bitwiseOR(F.col("at").cast("long"))

    def smaller(rows: DataFrame) -> DataFrame:
        each = rows.select(
            "id", "n", F.explode(F.array(F.col("band"), F.col("band") + 1)).alias("at_band"),
            F.slice("tokens", F.lit(1), _first(n, 2 * least / (1 + least))).alias("tokens"),
        ).select("id", "n", "at_band", F.posexplode("tokens").alias("at", "token"))
        return each.select(key.alias("key"), F.col("id").alias("a"), place.alias("pa"))

    def larger(rows: DataFrame) -> DataFrame:
        each = rows.select("id", "n", F.col("band").alias("at_band"), F.posexplode("tokens").alias("at", "token"))
        return each.select(key.alias("key"), F.col("id").alias("b"), place.alias("pb"))

    na, nb = F.shiftright("pa", 32), F.shiftright("pb", 32)
    after = lambda p, size: size - p.bitwiseAND(F.lit(0xFFFFFFFF)) - 1
    reach = 1 + F.least(after(F.col("pa"), na), after(F.col("pb"), nb))
    order = (na < nb) | ((na == nb) & (F.col("a") < F.col("b")))
    wanted = F.lit(least / (1 + least)) * (na + nb) - 1e-9
    fits = order & (F.col("a") != F.col("b")) & (na >= nb * F.lit(least) - 1e-9) & (reach >= wanted)
    if asked is None:
        met = smaller(reps).join(larger(reps), "key").filter(fits)
    else:
        some, rest = reps.filter("asked"), reps.filter("not asked")
        met = pin(smaller(some)).join(larger(reps), "key").filter(fits).unionByName(
            smaller(rest).join(pin(larger(some)), "key").filter(fits))
    pairs = pin(met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    ids = pin(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct())
    heads = classes.join(ids, F.col("class_id") == F.col("id"), "left_semi").select(
        F.col("class_id").alias("id"), F.col("fingerprint").alias("known"))
    own = (F.col("doc_id") == F.col("id")) & (F.col("fingerprint") == F.col("known"))
    drawn = pin(signed.join(pin(heads), own, "left_semi").select("doc_id", "set"))
    likeness = pairs.join(drawn.toDF("a", "sa"), "a").join(drawn.toDF("b", "sb"), "b").groupBy("a", "b").agg(
        F.max(pruned_jaccard(F.col("sa"), F.col("sb"), least)).alias("likeness")
    )
    found = pin(likeness.filter(F.col("likeness") >= least))
    links = found.select(F.explode(F.array("a", "b")).alias("class_id")).groupBy("class_id").agg(F.count("*").alias("links"))
    linked = classes.select("fingerprint", "class_id", "asked").join(links, "class_id", "left").select(
        "fingerprint", "class_id", F.when(F.col("asked"), F.coalesce("links", F.lit(0))).alias("links"))
    return members, linked, found


def near_pairs(
    docs: DataFrame, least: float = LIKENESS, common: list[str] = COMMON, chain: int = CHAIN, run: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """The members and pairs of ``near_classes``."""
    members, _, pairs = near_classes(docs, least, common, chain, run)
    return members, pairs


def compare_and_link(
    docs: DataFrame, common: list[str] = COMMON, chain: int = CHAIN, run: int | None = None, least: float = LIKENESS,
    asked: Column | None = None,
) -> DataFrame:
    """``compare_edits`` with the class of each row and the number of other classes that are near (NULL if the
    class is not ``asked`` for)."""
    _, classes, _ = near_classes(docs, least, common, chain, run, asked)
    return compare_edits(docs, common, chain, run).join(classes, "fingerprint", "left")
