"""Frameworks of packages: all that can use them, products and badges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairnlake.functions import frameworks as fw

FIRST_PRODUCTS = [fw.NET, fw.NET_CORE, fw.NET_STANDARD, fw.NET_FRAMEWORK]


def _parsed(named: DataFrame, key: str) -> DataFrame:
    """(key, own) of (key, name): every name is parsed once, not once a row; few they are, so Spark may broadcast them by their size."""
    # a filter on what comes from an aggregate is not pushed below it, where it would parse the name of every row
    names = named.groupBy("name").agg(F.max("name").alias("text")).select("name", fw.framework(F.col("text")).alias("own"))
    return named.join(names, "name").where(fw.is_specific(F.col("own"))).select(key, "own").distinct()


def usable_frameworks(assets: DataFrame, matrix: DataFrame, key: str = "identity") -> DataFrame:
    """(key, framework, is_computed) of assets (key, framework name): the frameworks that can use each package, parsed.

    matrix is the fixed table (package_framework, project_framework) of names. A framework is looked up without the version of its
    platform; if it has one, it stands for its entry among those found. One that the matrix lacks stands for itself. Names
    that are no frameworks, unsupported, portable and any drop out. is_computed: not named by the package itself."""
    named = _parsed(assets.select(key, F.lower(F.trim("framework")).alias("name")).distinct(), key)
    pairs = matrix.select(fw.framework(F.col("package_framework")).alias("base"), fw.framework(F.col("project_framework")).alias("project")).where("base is not null and project is not null").distinct()
    bare = fw.without_platform_version(F.col("own"))
    found = named.withColumn("base", bare).join(pairs, "base", "left")
    usable = F.when(F.col("project").isNull() | (F.col("project") == F.col("base")), F.col("own")).otherwise(F.col("project"))
    mark = named.select(key, F.col("own").alias("framework"), F.lit(False).alias("found"), F.lit(True).alias("own"))
    every = found.select(key, usable.alias("framework"), F.lit(True).alias("found"), F.lit(False).alias("own")).unionByName(mark)
    seen = every.groupBy(key, "framework").agg(F.max("own").alias("own"), F.max("found").alias("found"))
    return seen.where("found").select(key, "framework", (~F.col("own")).alias("is_computed"))


def product_table(usable: DataFrame, key: str = "identity") -> DataFrame:
    """(key, position, product, frameworks, badge): the products of each package in their order, four fixed ones and then the others by
    name, each with its frameworks (name, is_computed) in theirs and the first that the package names itself."""
    rows = usable.withColumn("product", fw.product(F.col("framework")))
    items = F.array_sort(F.collect_list(F.struct("framework", "is_computed")))
    grouped = rows.groupBy(key, "product").agg(items.alias("items"))
    shown = F.transform("items", lambda x: F.struct(fw.framework_name(x["framework"]).alias("framework"), x["is_computed"].alias("is_computed")))
    first = F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(p) for p in FIRST_PRODUCTS]), F.col("product")), F.lit(0).cast("long")), F.lit(len(FIRST_PRODUCTS) + 1).cast("long"))
    out = grouped.select(key, "product", shown.alias("frameworks"), first.alias("first"))
    own = F.try_element_at(F.transform(F.filter("frameworks", lambda x: ~x["is_computed"]), lambda x: x["framework"]), F.lit(1))
    products = F.array_sort(F.collect_list(F.struct("first", "product", "frameworks", own.alias("own"))))
    each = out.groupBy(key).agg(products.alias("products")).select(key, F.posexplode("products").alias("position", "p"))
    return each.select(key, "position", "p.product", "p.frameworks", F.when(F.col("p.product").isin(*FIRST_PRODUCTS), F.col("p.own")).alias("badge"))
