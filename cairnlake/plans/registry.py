"""Registry of the tables: columns in their fixed order, keys, bucket column and merge rule."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

PACKAGE_PREFIX = (
    "ScanId string, ScanTimestamp timestamp, LowerId string NOT NULL, Identity string NOT NULL, Id string NOT NULL, "
    "Version string NOT NULL, CatalogCommitTimestamp timestamp NOT NULL, Created timestamp, "
)
NO_PREFIX = ""

#: How rows of a table merge where the rule is not that of the package tables.
OTHER_MERGES = {
    "CatalogLeafItems": "distinct",
    "Certificates": "certificate_blocks",
    "PackageDownloads": "most_downloads",
    "PackageOwners": "sort",
    "PopularityTransfers": "sort",
    "VerifiedPackages": "sort",
    "ExcludedPackages": "sort",
    "GitHubUsages": "sort",
}


@dataclass(frozen=True)
class TableSpec:
    name: str
    keys: list[str]
    bucket: str
    prefix: str
    ddl: str

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.prefix + self.ddl)

    @property
    def merge(self) -> str:
        return OTHER_MERGES.get(self.name, "newest_batch")

    @property
    def text_schema(self) -> T.StructType:
        """The schema for reading and writing CSV: timestamps stay text, as they carry seven digits."""
        return T.StructType([T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.TimestampType) else f.dataType, True) for f in self.schema])


# The columns of each table in order, with the natural key and the column that picks the file bucket.
_SPECS = [
    TableSpec(
        "CatalogLeafItems", ['Identity', 'PageUrl', 'CommitTimestamp'], "Identity", NO_PREFIX,
        "CommitId string NOT NULL, CommitTimestamp timestamp NOT NULL, LowerId string NOT NULL, Identity string NOT "
        "NULL, Id string NOT NULL, Version string NOT NULL, Type string NOT NULL, Url string NOT NULL, PageUrl string "
        "NOT NULL, Published timestamp NOT NULL, IsListed boolean, Created timestamp, LastEdited timestamp, "
        "PackageSize bigint, PackageHash string, PackageHashAlgorithm string, Deprecation string, Vulnerabilities "
        "string, HasRepositoryProperty boolean, PackageEntryCount int, NuspecPackageEntry string, "
        "SignaturePackageEntry string",
    ),
    TableSpec(
        "Certificates", ['Fingerprint'], "Fingerprint", NO_PREFIX,
        "ScanId string, ScanTimestamp timestamp, ResultType string, Fingerprint string NOT NULL, FingerprintSHA256Hex "
        "string NOT NULL, FingerprintSHA1Hex string NOT NULL, Subject string NOT NULL, Issuer string NOT NULL, "
        "NotBefore timestamp NOT NULL, NotAfter timestamp NOT NULL, SerialNumber string NOT NULL, "
        "SignatureAlgorithmOid string NOT NULL, Version int NOT NULL, Extensions string NOT NULL, PublicKeyOid string "
        "NOT NULL, RawDataLength int NOT NULL, RawData string NOT NULL, IssuerFingerprint string, RootFingerprint "
        "string, ChainLength int, CodeSigningCommitTimestamp timestamp, CodeSigningStatus string, "
        "CodeSigningStatusFlags string, CodeSigningStatusUpdateTime timestamp, CodeSigningRevocationTime timestamp, "
        "TimestampingCommitTimestamp timestamp, TimestampingStatus string, TimestampingStatusFlags string, "
        "TimestampingStatusUpdateTime timestamp, TimestampingRevocationTime timestamp, Policies string",
    ),
    TableSpec(
        "ExcludedPackages", ['LowerId'], "LowerId", NO_PREFIX,
        "AsOfTimestamp timestamp, LowerId string NOT NULL, Id string NOT NULL, IsExcluded boolean NOT NULL",
    ),
    TableSpec(
        "GitHubUsages", ['LowerId', 'Repository'], "LowerId", NO_PREFIX,
        "AsOfTimestamp timestamp, LowerId string NOT NULL, Id string NOT NULL, ResultType string NOT NULL, Repository "
        "string, Stars int",
    ),
    TableSpec(
        "PackageExplorerFiles", ['Identity', 'Path'], "Identity", PACKAGE_PREFIX,
        "ResultType string NOT NULL, Path string, Extension string, HasCompilerFlags boolean, HasSourceLink boolean, "
        "HasDebugInfo boolean, CompilerFlags string, SourceUrlRepoInfo string, PdbType string",
    ),
    TableSpec(
        "PackageExplorers", ['Identity'], "Identity", PACKAGE_PREFIX,
        "ResultType string NOT NULL, SourceLinkResult string, DeterministicResult string, CompilerFlagsResult string, "
        "IsSignedByAuthor boolean",
    ),
    TableSpec(
        "PackageArchiveEntries", ['Identity', 'SequenceNumber'], "Identity", PACKAGE_PREFIX,
        "ResultType string NOT NULL, SequenceNumber int, Path string, FileName string, FileExtension string, "
        "TopLevelFolder string, Flags int, CompressionMethod int, LastModified timestamp, Crc32 bigint, "
        "CompressedSize bigint, UncompressedSize bigint, LocalHeaderOffset bigint, Comment string",
    ),
    TableSpec(
        "PackageArchives", ['Identity'], "Identity", PACKAGE_PREFIX,
        "ResultType string NOT NULL, Size bigint, OffsetAfterEndOfCentralDirectory bigint, CentralDirectorySize "
        "bigint, OffsetOfCentralDirectory bigint, EntryCount int, Comment string, HeaderMD5 string, HeaderSHA512 "
        "string, MD5 string, SHA1 string, SHA256 string, SHA512 string",
    ),
    TableSpec(
        "PackageAssemblies", ['Identity', 'SequenceNumber'], "Identity", PACKAGE_PREFIX,
        "ResultType string NOT NULL, SequenceNumber int, Path string, FileName string, FileExtension string, "
        "TopLevelFolder string, FileLength bigint, EdgeCases string, AssemblyName string, AssemblyVersion string, "
        "Culture string, PublicKeyToken string, HashAlgorithm string, HasPublicKey boolean, PublicKeyLength int, "
        "PublicKeySHA1 string, CustomAttributes string, CustomAttributesFailedDecode string, "
        "CustomAttributesTotalCount int, CustomAttributesTotalDataLength int",
    ),
    TableSpec(
        "PackageAssets", ['Identity', 'Path'], "Identity", PACKAGE_PREFIX,
        "ResultType string NOT NULL, PatternSet string, PropertyAnyValue string, PropertyCodeLanguage string, "
        "PropertyTargetFrameworkMoniker string, PropertyLocale string, PropertyManagedAssembly string, "
        "PropertyMSBuild string, PropertyRuntimeIdentifier string, PropertySatelliteAssembly string, Path string, "
        "FileName string, FileExtension string, TopLevelFolder string, RoundTripTargetFrameworkMoniker string, "
        "FrameworkName string, FrameworkVersion string, FrameworkProfile string, PlatformName string, PlatformVersion "
        "string",
    ),
    TableSpec(
        "PackageCertificates", ['Identity', 'Fingerprint'], "Identity", PACKAGE_PREFIX,
        "ResultType string NOT NULL, Fingerprint string NOT NULL, RelationshipTypes string NOT NULL",
    ),
    TableSpec(
        "PackageCompatibilities", ['Identity'], "Identity", PACKAGE_PREFIX,
        "ResultType string NOT NULL, HasError boolean NOT NULL, DoesNotRoundTrip boolean NOT NULL, HasAny boolean NOT "
        "NULL, HasUnsupported boolean NOT NULL, HasAgnostic boolean NOT NULL, BrokenFrameworks string, NuspecReader "
        "string, NU1202 string, Gallery string, GalleryEscaped string, GallerySupported string, "
        "GalleryBadges string",
    ),
    TableSpec(
        "PackageContents", ['Identity', 'SequenceNumber'], "Identity", PACKAGE_PREFIX,
        "ResultType string NOT NULL, Path string, FileExtension string, SequenceNumber int, Size int, Truncated "
        "boolean, TruncatedSize int, SHA256 string, Content string, DuplicateContent boolean",
    ),
    TableSpec(
        "PackageDeprecations", ['Identity'], "Identity", PACKAGE_PREFIX,
        "ResultType string NOT NULL, Message string, Reasons string, AlternatePackageId string, AlternateVersionRange "
        "string",
    ),
    TableSpec(
        "PackageDownloads", ['Identity'], "Identity", NO_PREFIX,
        "AsOfTimestamp timestamp, LowerId string NOT NULL, Identity string NOT NULL, Id string NOT NULL, Version "
        "string NOT NULL, Downloads bigint NOT NULL, TotalDownloads bigint NOT NULL",
    ),
    TableSpec(
        "PackageFiles", ['Identity', 'SequenceNumber'], "Identity", PACKAGE_PREFIX,
        "ResultType string NOT NULL, SequenceNumber int, Path string, FileName string, FileExtension string, "
        "TopLevelFolder string, CompressedLength bigint, EntryUncompressedLength bigint, ActualUncompressedLength "
        "bigint, SHA256 string, First16Bytes string",
    ),
    TableSpec(
        "PackageIcons", ['Identity'], "Identity", PACKAGE_PREFIX,
        "ResultType string NOT NULL, FileLength bigint, FileSHA256 string, ContentType string, HeaderFormat string, "
        "AutoDetectedFormat boolean, Signature string, Width bigint, Height bigint, FrameCount int, IsOpaque boolean, "
        "FrameFormats string, FrameDimensions string, FrameAttributeNames string",
    ),
    TableSpec(
        "PackageLicenses", ['Identity'], "Identity", PACKAGE_PREFIX,
        "ResultType string NOT NULL, Url string, Expression string, File string, GeneratedUrl string, "
        "ExpressionParsed string, ExpressionLicenses string, ExpressionExceptions string, "
        "ExpressionNonStandardLicenses string, ExpressionHasDeprecatedIdentifier boolean, FileLength bigint, "
        "FileSHA256 string, FileContent string",
    ),
    TableSpec(
        "PackageManifests", ['Identity'], "Identity", PACKAGE_PREFIX,
        "ResultType string NOT NULL, Size int, OriginalId string, OriginalVersion string, MinClientVersion string, "
        "DevelopmentDependency boolean, IsServiceable boolean, Authors string, Copyright string, Description string, "
        "Icon string, IconUrl string, Language string, LicenseUrl string, Owners string, ProjectUrl string, Readme "
        "string, ReleaseNotes string, RequireLicenseAcceptance boolean, Summary string, Tags string, Title string, "
        "PackageTypes string, LicenseMetadata string, RepositoryMetadata string, ReferenceGroups string, ContentFiles "
        "string, DependencyGroups string, FrameworkAssemblyGroups string, FrameworkRefGroups string, "
        "ContentFilesHasFormatException boolean, DependencyGroupsHasMissingId boolean, SplitTags string",
    ),
    TableSpec(
        "PackageOwners", ['LowerId'], "LowerId", NO_PREFIX,
        "AsOfTimestamp timestamp, LowerId string NOT NULL, Id string NOT NULL, Owners string NOT NULL",
    ),
    TableSpec(
        "PackageReadmes", ['Identity'], "Identity", PACKAGE_PREFIX,
        "ResultType string NOT NULL, Size int, LastModified timestamp, SHA256 string, Content string",
    ),
    TableSpec(
        "PackageSignatures", ['Identity'], "Identity", PACKAGE_PREFIX,
        "ResultType string NOT NULL, HashAlgorithm string NOT NULL, HashValue string, AuthorSHA1 string, AuthorSHA256 "
        "string, AuthorSubject string, AuthorNotBefore timestamp, AuthorNotAfter timestamp, AuthorIssuer string, "
        "AuthorTimestampSHA1 string, AuthorTimestampSHA256 string, AuthorTimestampSubject string, "
        "AuthorTimestampNotBefore timestamp, AuthorTimestampNotAfter timestamp, AuthorTimestampIssuer string, "
        "AuthorTimestampValue timestamp, AuthorTimestampHasASN1Error boolean NOT NULL, RepositorySHA1 string, "
        "RepositorySHA256 string, RepositorySubject string, RepositoryNotBefore timestamp, RepositoryNotAfter "
        "timestamp, RepositoryIssuer string, RepositoryTimestampSHA1 string, RepositoryTimestampSHA256 string, "
        "RepositoryTimestampSubject string, RepositoryTimestampNotBefore timestamp, RepositoryTimestampNotAfter "
        "timestamp, RepositoryTimestampIssuer string, RepositoryTimestampValue timestamp, "
        "RepositoryTimestampHasASN1Error boolean NOT NULL, PackageOwners string",
    ),
    TableSpec(
        "PackageVersions", ['Identity'], "LowerId", PACKAGE_PREFIX,
        "ResultType string NOT NULL, OriginalVersion string, FullVersion string, Major int NOT NULL, Minor int NOT "
        "NULL, Patch int NOT NULL, Revision int NOT NULL, Release string, ReleaseLabels string, Metadata string, "
        "IsPrerelease boolean NOT NULL, IsListed boolean, IsSemVer2 boolean, SemVerType string, SemVerOrder int NOT "
        "NULL, IsLatest boolean NOT NULL, IsLatestStable boolean NOT NULL, IsLatestSemVer2 boolean NOT NULL, "
        "IsLatestStableSemVer2 boolean NOT NULL, Published timestamp, LastEdited timestamp",
    ),
    TableSpec(
        "PackageVulnerabilities", ['Identity', 'AdvisoryUrl'], "Identity", PACKAGE_PREFIX,
        "ResultType string NOT NULL, GitHubDatabaseKey int, AdvisoryUrl string, Severity int",
    ),
    TableSpec(
        "PopularityTransfers", ['LowerId'], "LowerId", NO_PREFIX,
        "AsOfTimestamp timestamp, LowerId string NOT NULL, Id string NOT NULL, TransferIds string NOT NULL, "
        "TransferLowerIds string NOT NULL",
    ),
    TableSpec(
        "SymbolPackageArchiveEntries", ['Identity', 'SequenceNumber'], "Identity", PACKAGE_PREFIX,
        "ResultType string NOT NULL, SequenceNumber int, Path string, FileName string, FileExtension string, "
        "TopLevelFolder string, Flags int, CompressionMethod int, LastModified timestamp, Crc32 bigint, "
        "CompressedSize bigint, UncompressedSize bigint, LocalHeaderOffset bigint, Comment string",
    ),
    TableSpec(
        "SymbolPackageArchives", ['Identity'], "Identity", PACKAGE_PREFIX,
        "ResultType string NOT NULL, Size bigint, OffsetAfterEndOfCentralDirectory bigint, CentralDirectorySize "
        "bigint, OffsetOfCentralDirectory bigint, EntryCount int, Comment string, HeaderMD5 string, HeaderSHA512 "
        "string, MD5 string, SHA1 string, SHA256 string, SHA512 string",
    ),
    TableSpec(
        "SymbolPackageFiles", ['Identity', 'SequenceNumber'], "Identity", PACKAGE_PREFIX,
        "ResultType string NOT NULL, SequenceNumber int, Path string, FileName string, FileExtension string, "
        "TopLevelFolder string, CompressedLength bigint, EntryUncompressedLength bigint, ActualUncompressedLength "
        "bigint, SHA256 string, First16Bytes string",
    ),
    TableSpec(
        "VerifiedPackages", ['LowerId'], "LowerId", NO_PREFIX,
        "AsOfTimestamp timestamp, LowerId string NOT NULL, Id string NOT NULL, IsVerified boolean NOT NULL",
    ),
]

TABLES = {spec.name: spec for spec in _SPECS}


def history_of(spec: TableSpec) -> TableSpec:
    """The table that keeps a row for each moment of a snapshot table."""
    return TableSpec(f"{spec.name}History", [*spec.keys, "AsOfTimestamp"], spec.bucket, spec.prefix, spec.ddl)
