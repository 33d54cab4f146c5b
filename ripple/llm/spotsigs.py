"""SpotSigs: document fingerprints from chains of content words that follow common words.

Words are runs of letters and digits, in lower case; a letter of a script without spaces (``SPACELESS``) is a word.
The common words are counted over all documents (``frequent_words``): of each value of ``lang`` (null is one) and
script, and of numbers, the ``COMMON`` words that are in most documents, so that texts of any language get chains
along their whole length (fewer where there are so few words that this is more than a quarter of them); of all
these at most the ``COMMON_MOST`` most frequent. Words longer than ``WORD_CHARS``
are not common. Each run of common words, and the start of a text, anchors a chain of the next ``CHAIN`` content words; where common words lie between those, that is part of the
chain. A fingerprint is the set of its chains' 32-bit hashes, written as eight hex digits each in ascending order.
Likeness is the Jaccard coefficient of two such sets; two empty ones are alike.

``near_pairs`` finds all pairs above a threshold: sets are partitioned by length, as Jaccard is at most the ratio of
the lengths, so a set is compared inside its partition and the next; inside, sets meet only if they share one of the
rarest chains they cannot do without. Equal sets are one row there.

Only DataFrame functions run: regular expressions for the words, array functions for the chains. A document
finds its neighbour in id order by a distributed lead over (id, hash of the text); texts are shuffled once, by
that key, and the exchange is shared by both sides of the join.

Null text: empty, no chains. A text without content words has no chains either. Equal ids are ordered by the hash
of their texts; a null id comes last; a row that repeats whole gives as many equal rows. A table of one document
is its own neighbour. Empty table: empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ripple.llm.common import Scratch, text_or_empty

#: Frequent function words of four languages, for callers that count none.
ANCHORS = (
    "the of and to in a is that for it on with as was by be at from this are or an "
    "de la le et les des en un une du que est pour dans qui par sur pas au avec "
    "der die und den von zu das mit sich auf für ist im dem nicht ein eine auch es als "
    "el y los del se las por para con no su al lo como").split()
CHAIN = 3
NEAR = 0.8
COMMON, COMMON_MOST, WORD_CHARS = 32, 2_048, 32
SPACELESS = "".join(rf"\p{{Is{x}}}" for x in ("Han", "Hiragana", "Katakana", "Thai", "Lao", "Khmer", "Myanmar", "Tibetan"))


def _any_of(words: Iterable[str]) -> str:
    """A pattern for any of the words that looks at each letter once."""
    rest: dict[str, list[str]] = {}
    for word in sorted(set(words)):
        if word:
            rest.setdefault(word[0], []).append(word[1:])
    branches = [letter + (_any_of(tails) if any(tails) else "") for letter, tails in rest.items()]
    return "(?:" + "|".join(branches) + ")" + ("?" if "" in words else "")


def plain_words(text: Column, spaceless: bool) -> Column:
    """Words with a blank before and after each; with ``spaceless``, letters of such scripts are words of their own."""
    lower = F.lower(text)
    if spaceless:
        lower = F.regexp_replace(lower, f"([{SPACELESS}])", " $1 ")
    return F.regexp_replace(F.concat(F.lit(" "), lower, F.lit(" ")), r"[^\p{L}\p{N}]+", " ")


def script(word: Column) -> Column:
    """A number for the script of a word's first letter: its block of 256 code points; Latin, Han, Hangul and numbers whole."""
    first = F.ascii(word)
    return F.when(word.rlike(r"^\p{N}"), -1).when((first < 0x250) | first.between(0x1E00, 0x1EFF), 0) \
        .when(first.between(0x3400, 0x9FFF) | (first >= 0x20000), -2).when(first.between(0xAC00, 0xD7A3), -3) \
        .otherwise(F.shiftright(first, 8))


def frequent_words(docs: DataFrame, common: int = COMMON, most: int = COMMON_MOST) -> tuple[str, ...]:
    """The common words of ``docs``, by the number of documents that have them."""
    words = F.array_distinct(F.split(F.trim(plain_words(F.col("text"), True)), " "))
    counted = docs.select("lang", F.explode(words).alias("word")) \
        .filter(F.length("word").between(1, WORD_CHARS)).groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))
    group = Window.partitionBy("lang", "script")
    first = counted.withColumn("script", script(F.col("word"))) \
        .withColumn("place", F.row_number().over(group.orderBy(F.col("n").desc(), "word"))).filter(F.col("place") <= 4 * common)
    best = first.withColumn("words", F.count(F.lit(1)).over(group)).filter(F.col("place") * 4 <= F.col("words")) \
        .groupBy("word").agg(F.max("n").alias("n")).orderBy(F.col("n").desc(), "word").limit(most)
    return tuple(r.word for r in best.collect())


def content(text: Column, anchors=ANCHORS) -> Column:
    """Content words in order; one that follows an anchor is marked by ``~``."""
    plain = plain_words(text, any(ord(x[0]) >= 0xE00 for x in anchors))
    # one mark for each anchor, then one for each run of marks; a repeated group would need a stack frame per word
    marked = F.regexp_replace(plain, " " + _any_of(anchors) + "(?= )", " ~")
    marked = F.trim(F.regexp_replace(marked, " ~[ ~]*", " ~"))
    # the start of the text anchors too; common words at the end leave a mark without a word
    begun = F.regexp_replace(F.rtrim(F.regexp_replace(marked, "~$", "")), "^(?=[^~])", "~")
    return F.split(begun, " ")


def chains(words: Column, length: int = CHAIN) -> Column:
    """Set of the chains' hashes, ascending. ``words`` has to be a column, as it is read once per word."""
    def chain(word: Column, at: Column) -> Column:
        return F.when(F.startswith(word, F.lit("~")), F.hash(word, *[F.get(words, at + k) for k in range(1, length)]))
    return F.array_sort(F.array_distinct(F.array_compact(F.transform(words, chain))))


def digits(chain_set: Column) -> Column:
    """A set as text."""
    return F.array_join(F.transform(chain_set, lambda x: F.right(F.hex(x.cast("long") + F.lit(1 << 33)), F.lit(8))), "")


def likeness(a: Column, b: Column) -> Column:
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when(either == 0, 1.0).otherwise(both / either)


def signatures(docs: DataFrame, name: str = "chains", text: str = "text", anchors=ANCHORS) -> DataFrame:
    """``docs`` with its set of chains."""
    words = docs.withColumn("_words", content(F.coalesce(F.col(text), F.lit("")), anchors))
    return words.withColumn(name, chains(F.col("_words"))).drop("_words")


def neighbours(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """``k``, ``h``, ``n`` of each distinct document and ``next_k``, ``next_h`` of the next one in descending id order."""
    distinct = docs.groupBy("k", "h").agg(F.max(F.length("text")).alias("n"))
    order = [F.col("k").desc(), F.col("h").asc()]
    placed = scratch.save(distinct.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "order")
    inside = Window.partitionBy("_part").orderBy(*order)
    here = F.struct("k", "h")
    rows = placed.withColumn("_next", F.lead(here).over(inside))
    # one row per partition: where the next one begins, and at the end where the first begins
    heads = placed.groupBy("_part").agg(F.max("k").alias("k"), F.min_by("h", F.struct(-F.col("k").cast("decimal(20,0)"), "h")).alias("h"))
    in_order = Window.partitionBy(F.lit(0)).orderBy("_part")
    whole = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = heads.select("_part", F.coalesce(F.lead(here).over(in_order), F.first(here).over(whole)).alias("_after"))
    found = rows.join(after, "_part").withColumn("_next", F.coalesce("_next", "_after"))
    return found.select("k", "h", "n", F.col("_next.k").alias("next_k"), F.col("_next.h").alias("next_h"))


def fingerprints(docs: DataFrame, scratch: Scratch, anchors=ANCHORS) -> DataFrame:
    """Fingerprints of each document and of its edited text, and their likeness to each other and to the next document's.

    The edited text has its last third of code points replaced by as many first ones (or all) of the next document.
    """
    keyed = docs.select(F.coalesce(F.col("doc_id"), F.lit(-(1 << 63))).alias("k"), text_or_empty().alias("text")) \
        .withColumn("h", F.md5(F.col("text").cast("binary"))).select("k", "h", "text")
    order = scratch.save(neighbours(keyed, scratch), "next")
    wanted = order.select(F.col("next_k").alias("k"), F.col("next_h").alias("h"), F.col("k").alias("to_k"),
                          F.col("h").alias("to_h"), F.floor(F.col("n") / 3).cast("int").alias("third"))
    lent = signatures(keyed.join(wanted, ["k", "h"]), "next_chains", anchors=anchors).select(
        F.col("to_k").alias("k"), F.col("to_h").alias("h"), F.substring("text", F.lit(1), F.col("third")).alias("lent"), "next_chains") \
        .groupBy("k", "h").agg(F.first("lent").alias("lent"), F.first("next_chains").alias("next_chains"))
    n = F.length("text")
    rows = keyed.join(lent, ["k", "h"]).withColumn("n_chars", n.cast("long")) \
        .withColumn("edited", F.concat(F.substring("text", F.lit(1), n - F.floor(n / 3).cast("int")), F.col("lent"))) \
        .drop("lent")
    rows = signatures(signatures(rows, anchors=anchors), "edited_chains", "edited", anchors)
    return rows.select(
        F.nullif("k", F.lit(-(1 << 63))).alias("doc_id"), "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        digits(F.col("chains")).alias("fingerprint"), digits(F.col("edited_chains")).alias("edited_fingerprint"),
        likeness(F.col("chains"), F.col("edited_chains")).alias("near_edited"),
        likeness(F.col("chains"), F.col("next_chains")).alias("near_next"))


def near_pairs(docs: DataFrame, scratch: Scratch, near: float = NEAR, anchors=ANCHORS) -> tuple[DataFrame, DataFrame]:
    """(``doc_id``, ``set_id`` of every document with chains; ``a``, ``b``, ``likeness`` of sets at least ``near`` alike).

    With the ``anchors`` of ``fingerprints``, the sets are those fingerprints.
    """
    signed = signatures(docs.select("doc_id", "text"), anchors=anchors).filter(F.size("chains") > 0) \
        .select("doc_id", "chains", F.md5(digits(F.col("chains")).cast("binary")).alias("set_id"))
    signed = scratch.save(signed, "signed")
    sets = signed.groupBy("set_id").agg(F.first("chains").alias("chains")).withColumn("n", F.size("chains"))
    shares = sets.select("set_id", F.explode("chains").alias("chain"))
    frequency = shares.groupBy("chain").agg(F.count(F.lit(1)).alias("f"))
    # a set that shares none of its rarest n - ceil(near n) + 1 chains shares too few of the others
    ranked = shares.join(frequency, "chain").groupBy("set_id").agg(
        F.array_sort(F.collect_list(F.struct("f", "chain"))).alias("by_rarity"))
    sets = scratch.save(sets.join(ranked, "set_id").withColumn(
        "rare", F.transform(F.slice("by_rarity", F.lit(1), F.col("n") - F.ceil(F.col("n") * near - 1e-9).cast("int") + 1),
                            lambda x: x["chain"])).withColumn(
        "part", F.floor(F.log("n") / F.lit(-math.log(near)) + 1e-9)).drop("by_rarity"), "sets")
    left = sets.select("set_id", "n", "part", F.explode("rare").alias("chain"))
    right = left.select(F.col("set_id").alias("b"), F.col("n").alias("m"), "chain",
                        F.explode(F.array(F.col("part"), F.col("part") + 1)).alias("part"), F.col("part").alias("own"))
    # a set meets those of its own partition, each pair once, and those of the partition below
    met = left.join(right, ["chain", "part"]).filter(
        ((F.col("own") < F.col("part")) | (F.col("set_id") < F.col("b")))
        & (F.least("n", "m") >= F.greatest("n", "m") * near - 1e-9)).select(F.col("set_id").alias("a"), "b").distinct()
    mine = sets.select(F.col("set_id").alias("a"), F.col("chains").alias("x"))
    other = sets.select(F.col("set_id").alias("b"), F.col("chains").alias("y"))
    found = met.join(mine, "a").join(other, "b").select("a", "b", likeness(F.col("x"), F.col("y")).alias("likeness"))
    return signed.select("doc_id", "set_id"), found.filter(F.col("likeness") >= near - 1e-12)
