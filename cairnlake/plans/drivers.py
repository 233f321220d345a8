"""The drivers of the catalog: what each depends on, and those that are plans over events alone."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairnlake.functions import scalars
from cairnlake.functions.canonical_json import canonical_json
from cairnlake.operators import events, ranks

# The drivers and the drivers that must have reached a point before them.
DEPENDENCIES: dict[str, list[str]] = {
    "BuildVersionSet": [],
    "CatalogDataToCsv": [],
    "LoadBucketedPackage": [],
    "LoadLatestPackageLeaf": [],
    "LoadPackageArchive": [],
    "LoadPackageManifest": [],
    "LoadPackageReadme": [],
    "LoadPackageVersion": [],
    "LoadSymbolPackageArchive": [],
    "PackageArchiveToCsv": ["PackageFileToCsv"],
    "PackageAssemblyToCsv": ["LoadPackageArchive"],
    "PackageAssetToCsv": ["LoadPackageArchive"],
    "PackageCertificateToCsv": ["LoadPackageArchive"],
    "PackageCompatibilityToCsv": ["LoadPackageArchive", "LoadPackageManifest"],
    "PackageContentToCsv": ["LoadPackageArchive"],
    "PackageFileToCsv": ["LoadPackageArchive"],
    "PackageIconToCsv": [],
    "PackageLicenseToCsv": [],
    "PackageManifestToCsv": ["LoadPackageManifest"],
    "PackageReadmeToCsv": ["LoadPackageReadme"],
    "PackageSignatureToCsv": ["LoadPackageArchive"],
    "PackageVersionToCsv": ["LoadPackageVersion"],
    "SymbolPackageArchiveToCsv": ["SymbolPackageFileToCsv"],
    "SymbolPackageFileToCsv": ["LoadSymbolPackageArchive"],
}


def bucketed_packages(leaves: DataFrame, n: int = 1000) -> DataFrame:
    """The latest event of each package version with its bucket."""
    last = events.latest(leaves, ["lower_id", "lower_version"], ["commit_ticks", "url"])
    return last.withColumn("bucket", scalars.bucket(F.concat_ws("/", "lower_id", "lower_version"), n))


def package_versions(latest_leaves: DataFrame) -> DataFrame:
    """Version parts, order and latest flags of the latest events (id, version, listed, published, deleted, flags)."""
    df = latest_leaves.withColumn("LowerId", F.lower("id")).withColumn("Identity", scalars.identity(F.col("id"), F.col("version")))
    df = df.withColumn("__key", scalars.version_key(F.col("version"))).withColumn("IsPrerelease", scalars.version_part(F.col("version"), "release").isNotNull())
    df = df.withColumn("IsListed", ~F.col("deleted") & scalars.is_listed(F.col("listed"), F.col("published"))).withColumn("IsSemVer2", scalars.is_semver2(F.col("flags")))
    semver1, stable = ~F.col("IsSemVer2"), ~F.col("IsPrerelease")
    flags = {"IsLatest": F.col("IsListed") & semver1, "IsLatestStable": F.col("IsListed") & semver1 & stable, "IsLatestSemVer2": F.col("IsListed"), "IsLatestStableSemVer2": F.col("IsListed") & stable}
    return ranks.latest_flags(df, ["LowerId"], [F.col("__key")], flags).drop("__key")


def deprecations_and_vulnerabilities(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One deprecation row for each event, and at least one vulnerability row."""
    identity = scalars.identity(F.col("id"), F.col("version")).alias("Identity")
    kind = F.when(F.col("deleted"), "Deleted")
    dep = leaves.select(identity, kind.when(F.col("deprecation").isNull(), "NotDeprecated").otherwise("Deprecated").alias("ResultType"), F.col("deprecation.message").alias("Message"), F.to_json("deprecation.reasons").alias("Reasons"), F.col("deprecation.alternatePackage.id").alias("AlternatePackageId"), F.col("deprecation.alternatePackage.range").alias("AlternateVersionRange"))
    each = leaves.select(identity, "deleted", F.explode_outer("vulnerabilities").alias("v"))
    vul = each.select("Identity", kind.when(F.col("v").isNull(), "NotVulnerable").otherwise("Vulnerable").alias("ResultType"), F.when(F.col("v").isNotNull(), scalars.advisory_key(F.col("v.`@id`"))).alias("GitHubDatabaseKey"), F.col("v.advisoryUrl").alias("AdvisoryUrl"), F.col("v.severity").cast("int").alias("Severity"))
    return dep, vul


def leaf_items(leaves: DataFrame) -> DataFrame:
    """Rows of the table CatalogLeafItems: every event once, with what its leaf says, as JSON where that is nested.

    leaves (commit_id, commit_timestamp, id, version, deleted, url, page_url, published, listed, created, last_edited, package_size,
    package_hash, package_hash_algorithm, deprecation, vulnerabilities, repository, package_entries); deprecation is a struct,
    the last one an array of structs with a fullName. The first manifest among the entries counts, whatever the case of its
    extension, and the first entry that is exactly the signature. Deletions have commit, identity and publishing time alone."""
    lower = F.lower("id")
    version = F.coalesce(scalars.normalized_version(F.col("version")), F.col("version"))
    here = lambda c: F.when(~F.col("deleted"), c)
    as_json = lambda name: here(canonical_json(F.col(name), leaves.schema[name].dataType))
    entries = F.col("package_entries")
    entry = leaves.schema["package_entries"].dataType.elementType
    first = lambda test: here(canonical_json(F.get(F.filter(entries, test), 0), entry))
    return leaves.select(
        F.col("commit_id").alias("CommitId"), F.col("commit_timestamp").alias("CommitTimestamp"), lower.alias("LowerId"), F.concat_ws("/", lower, F.lower(version)).alias("Identity"),
        F.col("id").alias("Id"), F.col("version").alias("Version"), F.when(F.col("deleted"), "PackageDelete").otherwise("PackageDetails").alias("Type"),
        F.col("url").alias("Url"), F.col("page_url").alias("PageUrl"), F.col("published").alias("Published"), here(scalars.is_listed(F.col("listed"), F.col("published"))).alias("IsListed"),
        here(F.col("created")).alias("Created"), here(F.col("last_edited")).alias("LastEdited"), here(F.col("package_size")).alias("PackageSize"), here(F.col("package_hash")).alias("PackageHash"),
        here(F.col("package_hash_algorithm")).alias("PackageHashAlgorithm"), as_json("deprecation").alias("Deprecation"), as_json("vulnerabilities").alias("Vulnerabilities"),
        here(F.col("repository").isNotNull()).alias("HasRepositoryProperty"), here(F.when(entries.isNotNull(), F.size(entries))).alias("PackageEntryCount"),
        first(lambda e: F.lower(e["fullName"]).endswith(".nuspec")).alias("NuspecPackageEntry"), first(lambda e: e["fullName"] == ".signature.p7s").alias("SignaturePackageEntry"),
    ).distinct()


def package_readmes(leaves: DataFrame, stored: DataFrame) -> DataFrame:
    """(identity, ResultType, Size, LastModified, SHA256, Content) of the latest leaves (identity, deleted), one row each.

    stored (identity, readme_type, data, last_modified) holds what was fetched: Embedded, Legacy or None, by whatever the source
    answered. Bytes that are no UTF-8 become the replacement character, a byte order mark in front is left out; size and digest are
    of all bytes. A package that was not fetched has no readme. One join on the identity."""
    kind = F.when(F.col("deleted"), "Deleted").when(F.col("readme_type").isin("Embedded", "Legacy"), F.col("readme_type")).otherwise("None")
    has = lambda c: F.when(kind.isin("Embedded", "Legacy"), c)
    rows = leaves.select("identity", "deleted").join(stored.select("identity", "readme_type", "data", "last_modified"), "identity", "left")
    return rows.select("identity", kind.alias("ResultType"), has(F.octet_length("data")).alias("Size"), has(F.col("last_modified")).alias("LastModified"), has(scalars.base64_digest(F.col("data"))).alias("SHA256"), has(_text_of("data")).alias("Content"))


def package_licenses(leaves: DataFrame, parsed: DataFrame, files: DataFrame, expression_url: str = "", file_url: str = "") -> DataFrame:
    """(identity, ResultType, Url, Expression, File, GeneratedUrl, ExpressionLicenses, ExpressionExceptions, FileLength, FileSHA256, FileContent)
    of leaves (identity, deleted, license_file, license_expression, license_url), one row each.

    A file that is not blank goes before an expression, this before a URL. parsed (expression, licenses, exceptions, is_valid) has a row
    for each distinct expression, so that each is parsed once however many packages name it; one that is no valid expression has
    no lists. files (identity, data) are the fetched texts."""
    given = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    kind = F.when(F.col("deleted"), "Deleted").when(F.trim(F.coalesce("license_file", F.lit(""))) != "", "File")
    kind = kind.when(given("license_expression"), "Expression").when(given("license_url"), "Url").otherwise("None")
    here = lambda c: F.when(~F.coalesce("deleted", F.lit(False)), c)
    lists = parsed.where("is_valid").select(F.col("expression").alias("license_expression"), "licenses", "exceptions", F.lit(True).alias("__valid")).dropDuplicates(["license_expression"])
    rows = leaves.select("identity", "deleted", "license_file", "license_expression", "license_url").join(lists, "license_expression", "left").join(files.select("identity", "data"), "identity", "left")
    of_expression = F.when(F.col("__valid"), F.concat(F.lit(expression_url), F.replace("license_expression", F.lit(" "), F.lit("%20"))))
    as_json = lambda name: here(canonical_json(F.col(name), rows.schema[name].dataType))
    return rows.select(
        "identity", kind.alias("ResultType"), here(F.col("license_url")).alias("Url"), here(F.col("license_expression")).alias("Expression"), here(F.col("license_file")).alias("File"),
        here(F.when(given("license_file"), F.lit(file_url)).otherwise(of_expression)).alias("GeneratedUrl"), as_json("licenses").alias("ExpressionLicenses"), as_json("exceptions").alias("ExpressionExceptions"),
        here(F.octet_length("data")).cast("long").alias("FileLength"), here(scalars.base64_digest(F.col("data"))).alias("FileSHA256"), here(_text_of("data")).alias("FileContent"),
    )


def _text_of(data: str):
    """Bytes as UTF-8 text without a byte order mark in front; what is no UTF-8 becomes the replacement character."""
    mark = F.startswith(data, F.lit(bytes.fromhex("efbbbf")))
    return F.make_valid_utf8(F.when(mark, F.expr(f"substring({data}, 4)")).otherwise(F.col(data)).cast("string"))


def title(name: str) -> str:
    """The name of a driver in words: `LoadPackageReadme` is `Load package readme`, `...ToCsv` ends with `to CSV`."""
    words = re.sub(r"(?<!^)([A-Z])", lambda m: " " + m[1].lower(), name)
    return re.sub(r"(?i) csv$", " CSV", words)


def compatible_frameworks(assets: DataFrame, matrix: DataFrame) -> DataFrame:
    """(identity, framework, is_computed): the frameworks of a package and all that can use them. matrix is the fixed
    table (package_framework, project_framework); frameworks that it lacks stand for themselves."""
    own = assets.select("identity", "framework").distinct()
    wide = own.join(matrix, own["framework"] == matrix["package_framework"], "left").select("identity", F.coalesce("project_framework", "framework").alias("framework")).unionByName(own).distinct()
    mark = own.withColumn("__own", F.lit(True))
    return wide.join(mark, ["identity", "framework"], "left").select("identity", "framework", F.col("__own").isNull().alias("is_computed"))


def framework_badges(frameworks: DataFrame, products: DataFrame) -> DataFrame:
    """(identity, product, badge): the lowest framework of each product that a package has itself. products is the fixed
    table (framework, product, sort_key)."""
    own = frameworks.where(~F.col("is_computed")).join(products, "framework")
    return own.groupBy("identity", "product").agg(F.min_by("framework", "sort_key").alias("badge"))


# Bits of a certificate chain's status.
REVOKED, REVOCATION_UNKNOWN, PARTIAL_CHAIN, OFFLINE = 0x4, 0x40, 0x10000, 0x1000000


def chain_status(built, end_flags, parent_flags):
    """Good, Revoked, Invalid or Unknown from whether a chain was built and the status bits of the certificate at its
    end and of those above it."""
    soft = REVOCATION_UNKNOWN | OFFLINE
    hard = end_flags.bitwiseOR(parent_flags).bitwiseAND(~soft)
    return F.when(built, "Good").when((end_flags == REVOKED) & (parent_flags == 0), "Revoked").when(hard != 0, "Invalid").otherwise("Unknown")
