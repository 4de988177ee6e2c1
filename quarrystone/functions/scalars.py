"""Column functions of the preparation pipeline: names, paths, hashes, sizes, rates and distances."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = r"^\s+|\s+$"


def stripped(c: Column) -> Column:
    """Without white space at either end; Spark's trim only knows blanks."""
    return F.regexp_replace(c, BLANKS, "")


def falsy_coalesce(*columns: Column) -> Column:
    """The first string that is neither null nor empty; null if there is none."""
    return F.coalesce(*(F.nullif(c, F.lit("")) for c in columns))


def falsy_coalesce_number(*columns: Column) -> Column:
    """The first number that is neither null nor zero."""
    return F.coalesce(*(F.nullif(c, F.lit(0)) for c in columns))


def slugify(c: Column, length: int = 96, empty: str = "item") -> Column:
    """Runs outside letters, digits, dot, underscore and hyphen become one underscore."""
    joined = F.regexp_replace(c, "[^A-Za-z0-9._-]+", "_")
    return F.coalesce(F.nullif(F.left(F.btrim(joined, F.lit("_")), F.lit(length)), F.lit("")), F.lit(empty))


def sanitize_filename(c: Column) -> Column:
    """A name that common file systems accept, of at most 255 characters."""
    return F.left(F.btrim(F.regexp_replace(c, r'[<>:"/\\|?*]', "_"), F.lit(". ")), F.lit(255))


def human_size(c: Column) -> Column:
    """Bytes in binary units with two decimals, halves to even."""
    # Unit names in steps of 1024.
    units = ("B", "KiB", "MiB", "GiB", "TiB")
    size = c.cast("double")
    out = F.format_string("%.2f TiB", F.bround(size / 1024**4, 2))
    for power in range(len(units) - 2, -1, -1):
        out = F.when(size < 1024 ** (power + 1), F.format_string(f"%.2f {units[power]}", F.bround(size / 1024**power, 2))).otherwise(out)
    return out


def short_text(c: Column, length: int) -> Column:
    """The tail behind an ellipsis where the text is longer than ``length``."""
    c = F.coalesce(c, F.lit(""))
    return F.when(F.length(c) <= length, c).otherwise(F.concat(F.lit("..."), F.right(c, F.lit(length - 3))))


def base_url(c: Column) -> Column:
    return F.rtrim(c, F.lit("/"))


def dataset_directory(c: Column) -> Column:
    return sanitize_filename(F.replace(c, F.lit("/"), F.lit("_")))


def short_sha1(c: Column) -> Column:
    return F.substring(F.sha1(c), 1, 12)


def short_md5(c: Column) -> Column:
    return F.substring(F.md5(c), 1, 12)


def pdf_id(ordinal: Column, rel_path: Column) -> Column:
    """Position and path digest; positions shift when files are added."""
    return F.concat(F.format_string("pdf_%06d_", ordinal), short_sha1(rel_path))


def stable_pdf_id(content_sha256: Column) -> Column:
    """An id that depends on the content alone."""
    return F.concat(F.lit("pdf_"), F.substring(content_sha256, 1, 16))


def chunk_id(c: Column) -> Column:
    """``7``, ``0007`` and ``chunk_7`` to ``chunk_0007``; anything else is null (validity is the caller's)."""
    number = F.regexp_extract(c, r"^(?:chunk_)?(\d+)$", 1)
    return F.when(number != "", F.format_string("chunk_%04d", number.cast("int")))


def run_id(at: Column, prefix: str = "chunk_plan") -> Column:
    """The id of a run that starts ``at`` a time (UTC)."""
    return F.concat(F.lit(f"{prefix}_"), F.date_format(at, "yyyyMMdd'T'HHmmss'Z'"))


# Folders below a run's root, by what they hold.
RUN_FOLDERS = {"plan": "", "raw": "raw/", "artifacts": "artifacts/"}


def run_root(root: str, run: Column, kind: str) -> Column:
    """Where a run keeps its plan, raw responses or artifacts."""
    return F.concat(F.lit(f"{root.rstrip('/')}/{RUN_FOLDERS[kind]}"), run)


def artifact_root(raw_root: Column, at: Column) -> Column:
    """The artifact folder that belongs to a raw folder: beside ``raw`` a new run's, else the run's of the same name."""
    parts = F.split(F.rtrim(raw_root, F.lit("/")), "/")
    above = lambda n: F.array_join(F.slice(parts, 1, F.size(parts) - n), "/")
    own = F.element_at(parts, -1)
    return F.when(own == "raw", F.concat(above(1), F.lit("/artifacts/"), run_id(at, "materialized"))).otherwise(F.concat(above(2), F.lit("/artifacts/"), own))


def log_file(root: str, chunk: Column) -> Column:
    return F.concat(F.lit(f"{root.rstrip('/')}/logs/ocr_modal_run_"), chunk, F.lit(".log"))


def window_errors(start: Column, end: Column, width: Column) -> Column:
    """What is wrong with a page range and window size: the first rule that fails, else null."""
    return F.when(~F.coalesce(start > 0, F.lit(False)), "page start must be positive").when(end < start, "page end lies before page start").when(~F.coalesce(width > 0, F.lit(False)), "window size must be positive")


def window_file(begin: Column, end: Column) -> Column:
    return F.format_string("pages_%04d_%04d.raw.json", begin, end)


# Directory names of the bucket rules, in lower case, and the buckets' names.
EXCLUDED_DIRECTORY, EXCLUDED_BUCKET = "coverage-agreements", "excluded/coverage-agreements"
PUBLIC_DIRECTORY, PUBLIC_PREFIX = "publicreports", "public_reports/"
AUDIT_DIRECTORIES, AUDIT_BUCKET = ("sherlock-reports", "audits"), "sherlock_reports/audits"
OTHER_BUCKET = "other_audit_repo_pdfs"


def path_bucket(path: Column) -> Column:
    """The inventory bucket of a relative path; the first rule that holds decides."""
    parts = F.split(path, "/")
    low = F.transform(parts, F.lower)
    return (
        F.when(F.array_contains(low, EXCLUDED_DIRECTORY), EXCLUDED_BUCKET)
        .when((F.get(low, F.lit(0)) == PUBLIC_DIRECTORY) & (F.size(parts) >= 2), F.concat(F.lit(PUBLIC_PREFIX), F.get(parts, F.lit(1))))
        .when((F.size(parts) >= 3) & (F.slice(low, 1, 2) == F.array(*map(F.lit, AUDIT_DIRECTORIES))), AUDIT_BUCKET)
        .otherwise(OTHER_BUCKET)
    )


def path_ref(path: Column, base: Column) -> Column:
    """Relative to ``base`` if below it, else the whole path."""
    root = F.concat(F.rtrim(base, F.lit("/")), F.lit("/"))
    return F.when(base.isNotNull() & path.startswith(root), F.substr(path, F.length(root) + 1)).otherwise(path)


def extension(path: Column) -> Column:
    """The lower-cased suffix of a file name with its dot, or ``no_extension``."""
    name = F.element_at(F.split(path, "/"), -1)
    suffix = F.lower(F.regexp_extract(name, r"[^.](\.[^.]+)$", 1))
    return F.coalesce(F.nullif(suffix, F.lit("")), F.lit("no_extension"))


# File kinds by suffix.
SOLIDITY = (".sol",)
DOCUMENTS = (".md", ".pdf", ".txt", ".html")
DATA = (".json", ".csv", ".yaml", ".yml")
IMAGES = (".png", ".jpg", ".jpeg", ".webp")


def file_kind(path: Column) -> Column:
    suffix = extension(path)
    return F.when(suffix.isin(*SOLIDITY), "solidity").when(suffix.isin(*DOCUMENTS), "document").when(suffix.isin(*DATA), "data").when(suffix.isin(*IMAGES), "image").otherwise("other")


def ocr_kind(path: Column) -> Column:
    """``pdf`` or ``image``; other suffixes are errors."""
    suffix = extension(path)
    wrong = F.raise_error(F.concat(F.lit("unsupported file type: "), path))
    return F.when(suffix == ".pdf", "pdf").when(suffix.isin(*IMAGES), "image").otherwise(wrong)


def mime_type(path: Column) -> Column:
    suffix = extension(path)
    image = F.concat(F.lit("image/"), F.when(suffix == ".jpg", "jpeg").otherwise(F.substr(suffix, F.lit(2))))
    return F.when(suffix.isin(*IMAGES), image).when(suffix == ".pdf", "application/pdf").otherwise("application/octet-stream")


def data_url(path: Column, content: Column) -> Column:
    return F.concat(F.lit("data:"), mime_type(path), F.lit(";base64,"), F.base64(content))


def owner_repo(url: Column) -> Column:
    """``owner/repo`` of a repository URL, null if its path is shorter."""
    parts = F.split(F.btrim(F.try_parse_url(url, F.lit("PATH")), F.lit("/")), "/")
    return F.when(F.size(parts) >= 2, F.concat_ws("/", F.get(parts, F.lit(0)), F.regexp_replace(F.get(parts, F.lit(1)), r"\.git$", "")))


def same_host(url: Column, base: Column) -> Column:
    """True for a relative URL or one of the base's host."""
    host = F.try_parse_url(url, F.lit("HOST"))
    return host.isNull() | (host == F.try_parse_url(base, F.lit("HOST")))


def join_root(base: Column, href: Column) -> Column:
    """An absolute URL: absolute ones stay, scheme-relative ones get https, others hang on the site root."""
    root = F.concat(F.try_parse_url(base, F.lit("PROTOCOL")), F.lit("://"), F.try_parse_url(base, F.lit("HOST")))
    return F.when(href.rlike("(?i)^[a-z][a-z0-9+.-]*:"), href).when(href.startswith("//"), F.concat(F.lit("https:"), href)).when(href.startswith("/"), F.concat(root, href)).otherwise(F.concat(base_url(base), F.lit("/"), href))


def placeholder_null(c: Column) -> Column:
    """Null for empty settings and for ``your_...`` placeholders."""
    return F.when((stripped(c) == "") | F.lower(c).startswith("your_"), None).otherwise(c)


def swc_id(text: Column, href: Column) -> Column:
    number = F.coalesce(*(F.nullif(F.regexp_extract(c, r"(?i)SWC[- ]?(\d+)", 1), F.lit("")) for c in (text, href)))
    return F.concat(F.lit("SWC-"), number)


def sc_id(text: Column) -> Column:
    """Two digits at least; longer numbers are not cut."""
    number = F.nullif(F.regexp_extract(text, r"(?i)SC[- ]?(\d+)", 1), F.lit(""))
    return F.concat(F.lit("SC"), F.when(F.length(number) < 2, F.lpad(number, 2, "0")).otherwise(number))


def throughput(units: Column, milliseconds: Column) -> Column:
    """Units a second to three decimals; null unless both are positive."""
    return F.when((units > 0) & (milliseconds > 0), F.round(units * 1000.0 / milliseconds, 3))


def normalized_error(expected: Column, actual: Column) -> Column:
    return F.least(F.lit(1.0), F.abs(expected - actual) / F.greatest(F.lit(1.0), F.abs(expected)))


def relative_error(expected: Column, actual: Column) -> Column:
    return F.abs(expected - actual) / F.greatest(F.lit(1.0), F.abs(expected))


def same_sign(a: Column, b: Column) -> Column:
    return F.signum(a) == F.signum(b)


def weighted_distance(weights: dict[str, float], errors: dict[str, Column]) -> Column:
    total = F.lit(0.0)
    for name, weight in weights.items():
        total = total + F.lit(weight) * errors[name]
    return total


def fidelity(distance: Column, largest: float) -> Column:
    return 1.0 - distance / F.lit(largest)


def mistake_weight(penalties: list[tuple[Column, float]]) -> Column:
    """1 plus the penalty of every condition that holds."""
    total = F.lit(1.0)
    for condition, beta in penalties:
        total = total + F.when(condition, beta).otherwise(0.0)
    return total


def jaccard(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))), F.lit(0.0))


def detection_reward(correct: Column, lines: Column, true_lines: Column, validated: Column) -> Column:
    """The mean of the class reward, the line overlap and, where validated, one half."""
    base = F.when(correct, 1.0).otherwise(-1.0) + jaccard(lines, true_lines)
    return F.when(validated, (base + 0.5) / 3).otherwise(base / 2)


def cache_key(*columns: Column) -> Column:
    """A digest of several fields; lengths part them, so no two field lists run together."""
    return F.sha2(F.concat_ws("|", *(F.concat_ws(":", F.length(c.cast("string")).cast("string"), c.cast("string")) for c in columns)), 256)
