"""Document fingerprints from spot signatures, in DataFrame functions only.

Common words are anchors. Each content word that follows one or more anchors starts a signature: the chain of
it and the next content words, common words left out. The set of a text's signatures is its fingerprint;
likeness is the Jaccard measure of two sets. A text without signatures has one made of all its content
words, and a text without words has none; two empty sets are alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cairnlake.llm.common import shuffle_partitions

# Common words of English, German, French and Spanish.
COMMON_WORDS = (
    "a an and are as at be by for from has he in is it of on or that the this to was were will with not you they "
    "der die das den dem des ein eine einer und oder ist im zu von mit auf für sich nicht als auch es an werden "
    "le la les un une des du de et est en que qui dans pour par sur pas avec au ce il "
    "el los las una unos del y o es en que se por con para su al lo como más no"
).split()
CHAIN = 3
BLOCKS_PER_PARTITION = 8

_MARK = "\u0001"


def content_words(words: Column) -> Column:
    """Of the words of a text, the content words in order; those right after common words carry a mark."""

    def marked(word: Column, i: Column) -> Column:
        after = (i > 0) & F.get(words, i - 1).isin(COMMON_WORDS)
        return F.when(word.isin(["", *COMMON_WORDS]), F.lit("")).when(after, F.concat(F.lit(_MARK), word)).otherwise(word)

    return F.array_remove(F.transform(words, marked), "")


def spots(words: Column, chain: int = CHAIN) -> Column:
    """The distinct signatures of marked content words as 64-bit hashes, in order."""
    last = F.size(words) - chain

    def spot(word: Column, i: Column) -> Column:
        rest = [F.get(words, i + k) for k in range(1, chain)]
        return F.when(word.startswith(_MARK) & (i <= last), F.xxhash64(F.translate(F.concat_ws(" ", word, *rest), _MARK, "")))

    return F.sort_array(F.array_distinct(F.array_compact(F.transform(words, spot))))


def with_signatures(df: DataFrame, text_col: str, name: str, chain: int = CHAIN) -> DataFrame:
    """df with the signatures of a text column. Each step is a column of its own, so nothing is computed twice."""
    df = df.withColumn("__all", F.split(F.lower(text_col), r"[^\p{L}\p{N}]+"))
    df = df.withColumn("__words", content_words(F.col("__all"))).withColumn("__spots", spots(F.col("__words"), chain))
    whole = F.when(F.size("__words") > 0, F.array(F.xxhash64(F.translate(F.array_join("__words", " "), _MARK, "")))).otherwise(F.array().cast("array<bigint>"))
    return df.withColumn(name, F.when(F.size("__spots") > 0, F.col("__spots")).otherwise(whole)).drop("__all", "__words", "__spots")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard measure of two signature sets."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)


def digest(sigs: Column) -> Column:
    """A fingerprint string: equal for equal sets."""
    return F.sha2(F.array_join(sigs.cast("array<string>"), ","), 256)


def _cuts(ids: DataFrame, blocks: int) -> list[int]:
    """Ids that cut a table into about `blocks` blocks of like numbers of rows, however the ids lie; at most `blocks` values."""
    shares = [i / blocks for i in range(1, blocks)]
    found = ids.where("id is not null").agg(F.percentile_approx("id", shares, 10 * blocks).alias("cuts")).first()["cuts"]
    return sorted(set(found or []))


def _block(id_: Column, cuts: list[int]) -> Column:
    """How many cuts are not above the id. A coarse step over every 32nd cut leaves 32 for the fine one."""
    if not cuts:
        return F.lit(0)
    below = lambda some: F.size(F.filter(some, lambda cut: cut <= id_))
    coarse = 32 * below(F.array(*map(F.lit, cuts[31::32]))) if len(cuts) > 31 else F.lit(0)
    return coarse + below(F.slice(F.array(*map(F.lit, cuts)), coarse + 1, 32))


def with_next(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, sigs, next_text, next_sigs): each row with the next one by descending id, the first after the last.

    Rows are taken in blocks of ids that hold about equally many rows, by percentiles of the ids. Each block also gets
    the first row of the block after it, so no task orders more than a block; the order of the blocks themselves is a
    table of at most BLOCKS_PER_PARTITION rows for each shuffle partition. Null ids come last; equal ids follow by
    text; null texts count as empty. Rows of one id, and those of null ids, are one block."""
    lowest = F.lit(-(2**63))
    rows = df.select(F.coalesce(F.col(id_col).cast("long"), lowest).alias("id"), F.col(id_col).alias("own"), F.coalesce(text_col, F.lit("")).alias("text"))
    cuts = _cuts(df.select(F.col(id_col).cast("long").alias("id")), BLOCKS_PER_PARTITION * shuffle_partitions(df.sparkSession))
    rows = rows.withColumn("block", _block(F.col("id"), cuts))
    tops = rows.groupBy("block").agg(F.max("id").alias("top"))
    order = Window.orderBy(F.desc("block"))  # one row for each block
    after = tops.select("block", F.coalesce(F.lead("top").over(order), F.max("top").over(Window.partitionBy())).alias("top"))
    first = F.struct("text", "own")
    starts = rows.join(F.broadcast(tops.select("top")), F.col("id") == F.col("top"), "left_semi").groupBy("id").agg(F.min(first).alias("first"))
    guests = starts.join(F.broadcast(after), F.col("id") == F.col("top")).select("id", "first.own", "first.text", "block", F.lit(True).alias("guest"))
    both = rows.select("id", "own", "text", "block", F.lit(False).alias("guest")).unionByName(guests).repartition("block")
    both = with_signatures(both, "text", "sigs")
    by = Window.partitionBy("block").orderBy("guest", F.desc("id"), "text")
    both = both.withColumn("next_text", F.lead("text").over(by)).withColumn("next_sigs", F.lead("sigs").over(by))
    return both.where(~F.col("guest")).select(F.col("own").alias("id"), "text", "sigs", "next_text", "next_sigs")


def compare_edits(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edit, whose last half is the beginning of the next text:
    (id_col, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)."""
    rows = with_next(df, id_col, text_col)
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - half), F.substring("next_text", F.lit(1), half))
    rows = rows.withColumn("edited", edited)
    rows = with_signatures(rows, "edited", "edited_sigs")
    return rows.select(
        F.col("id").alias(id_col), F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        digest(F.col("sigs")).alias("fingerprint"), digest(F.col("edited_sigs")).alias("edited_fingerprint"),
        likeness(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"), likeness(F.col("sigs"), F.col("next_sigs")).alias("near_next"),
    )


def near_duplicates(df: DataFrame, threshold: float = 0.75, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b, likeness) of class representatives whose signature sets are similar, and the membership
    (id_col, rep) of every row with signatures.

    Equal sets are one class, represented by their smallest id. Classes are partitioned by set length, in bands
    one threshold wide, and meet through the rarest signatures of their sets: similar sets share one of the
    first |A| - ceil(t |A|) + 1. Pairs whose lengths or positions rule a match out are pruned before the sets
    are compared. Null ids and texts without words are left out."""
    texts = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = with_signatures(texts, "text", "sigs").where("id is not null and size(sigs) > 0").select("id", "sigs")
    classes = rows.groupBy("sigs").agg(F.min("id").alias("rep"))
    members = rows.join(classes, "sigs").select(F.col("id").alias(id_col), "rep")
    sized = classes.withColumn("size", F.size("sigs")).withColumn("band", F.floor(-F.log(F.col("size").cast("double")) / F.log(F.lit(threshold))))
    spread = sized.select("rep", "size", "band", F.explode("sigs").alias("sig"))
    rare = spread.groupBy("sig").agg(F.count("*").alias("used"))
    by = Window.partitionBy("rep").orderBy("used", "sig")
    placed = spread.join(rare.where("used > 1"), "sig", "left").where("used is not null").withColumn("at", F.row_number().over(by))
    # signatures used once are shared with nothing; they stand first in every set
    single = spread.groupBy("rep").agg(F.count("*").alias("n")).join(placed.groupBy("rep").agg(F.count("*").alias("m")), "rep").select("rep", (F.col("n") - F.col("m")).alias("ahead"))
    placed = placed.join(single, "rep").withColumn("place", F.col("at") + F.col("ahead")).where(F.col("place") <= F.col("size") - F.ceil(F.col("size") * threshold) + 1)
    left = placed.select("sig", F.col("rep").alias("a"), F.col("size").alias("size_a"), F.col("place").alias("place_a"), "band")
    right = placed.select("sig", F.col("rep").alias("b"), F.col("size").alias("size_b"), F.col("place").alias("place_b"), F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)).alias("band"))
    smaller, larger = F.least("size_a", "size_b"), F.greatest("size_a", "size_b")
    reach = F.least(F.col("size_a") - F.col("place_a"), F.col("size_b") - F.col("place_b")) + 1
    fits = (smaller >= larger * threshold) & (reach * (1 + threshold) >= (F.col("size_a") + F.col("size_b")) * threshold)
    pairs = left.join(right, ["sig", "band"]).where((F.col("a") < F.col("b")) & fits).select("a", "b").distinct()
    sets = classes.select("rep", "sigs")
    pairs = pairs.join(sets.select(F.col("rep").alias("a"), F.col("sigs").alias("sigs_a")), "a").join(sets.select(F.col("rep").alias("b"), F.col("sigs").alias("sigs_b")), "b")
    return pairs.select("a", "b", likeness(F.col("sigs_a"), F.col("sigs_b")).alias("likeness")).where(F.col("likeness") >= threshold), members
