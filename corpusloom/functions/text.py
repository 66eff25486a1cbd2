"""String expressions of captions, conversations, placeholders and names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Placeholder tokens of interleaved image-text rows (fixed values).
SOURCE_TOKEN = "<|reserved_special_token_0|>"


def image_token(k: Column) -> Column:
    """The output token of the k-th image, from 1."""
    return F.concat(F.lit("<|img"), k.cast("string"), F.lit("|>"))


def truthy(*values: Column) -> Column:
    """The first value that is neither null nor empty; the last one if there is none."""
    return F.coalesce(*(F.nullif(v, F.lit("")) for v in values[:-1]), values[-1])


def stem(path: Column) -> Column:
    """The file name without its last extension."""
    return F.regexp_replace(basename(path), r"(?<=.)\.[^.]*$", "")


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def extension_in(path: Column, *extensions: str) -> Column:
    """Whether the name ends in one of the extensions, whatever its case."""
    return F.lower(path).rlike(r"\.(" + "|".join(extensions) + ")$")


def path_part(path: Column, k: int) -> Column:
    """The k-th component from 0, null beyond the end."""
    return F.get(F.split(path, "/"), F.lit(k))


def path_depth(path: Column) -> Column:
    return F.size(F.split(path, "/"))


def prefix_class(name: Column, classes: list[str], joint: str = "_") -> Column:
    """The longest class whose name and ``joint`` begin ``name``; null if none does."""
    out = F.lit(None).cast("string")
    for c in sorted(classes, key=len):
        out = F.when(name.startswith(c + joint), F.lit(c)).otherwise(out)
    return out


def class_caption(key: Column, captions: dict[str, str]) -> Column:
    """The caption of a class; null for unknown classes."""
    table = F.create_map(*(F.lit(x) for pair in captions.items() for x in pair))
    return F.try_element_at(table, key)


def xray_caption(findings: Column, age: Column, gender: Column, view: Column) -> Column:
    """A sentence for a chest X-ray's record; all four fields are trimmed."""
    f, a, g, v = (F.trim(F.coalesce(c, F.lit(""))) for c in (findings, age, gender, view))
    person = F.when(g == "M", "male").when(g == "F", "female").otherwise("unknown gender")
    start = F.concat(F.lit("A chest X-ray ("), v, F.lit(" view) of a "), a, F.lit("-year-old "), person, F.lit(" patient showing "))
    none = F.lit("no significant pathological findings.")
    return F.concat(start, F.when(f == "No Finding", none).otherwise(F.concat(F.lit("findings of "), F.replace(f, F.lit("|"), F.lit(", ")), F.lit("."))))


def number_placeholders(text: Column, images: Column, token: str = SOURCE_TOKEN) -> Column:
    """The k-th occurrence of ``token`` becomes the k-th image's token, up to ``images`` of them.

    Further occurrences stay; tokens of images without an occurrence are put in front, on a line of
    their own.
    """
    parts = F.split(text, F.lit("\\Q" + token + "\\E"))
    mark = lambda i: F.when(i <= images, image_token(i)).otherwise(F.lit(token))
    body = F.array_join(F.transform(parts, lambda p, i: F.when(i == 0, p).otherwise(F.concat(mark(i), p))), "")
    spare = images - (F.size(parts) - 1)
    front = F.array_join(F.transform(F.sequence(images - spare + 1, images), image_token), "")
    return F.when(spare > 0, F.concat(front, F.lit("\n"), body)).otherwise(body)


def ensure_tokens(text: Column, images: Column) -> Column:
    """Put the tokens that the text lacks in front of it, on a line of their own."""
    wanted = F.when(images > 0, F.transform(F.sequence(F.lit(1), images), image_token)).otherwise(F.array().cast("array<string>"))
    missing = F.filter(wanted, lambda t: ~F.contains(text, t))
    return F.when(F.size(missing) > 0, F.concat(F.array_join(missing, ""), F.lit("\n"), text)).otherwise(text)


def sections(*named: tuple[str, Column], absent: tuple[str, ...] = ("", "N/A")) -> Column:
    """``Name: value`` lines of the values that are present."""
    lines = [F.when(~F.coalesce(v, F.lit("")).isin(*absent), F.concat(F.lit(n + ": "), v)) for n, v in named]
    return F.concat_ws("\n", *lines)


def record_key(dataset_id: Column, sample_id: Column) -> Column:
    return F.format_string("%s__%08d", dataset_id, sample_id)


def cache_name(name: Column) -> Column:
    """The cache folder of a hub dataset."""
    return F.concat(F.lit("datasets--"), F.replace(name, F.lit("/"), F.lit("--")))


def dataset_name(folder: Column) -> Column:
    """The hub dataset of a cache folder: only the first double hyphen stood for a slash."""
    return F.regexp_replace(F.regexp_replace(folder, "^datasets--", ""), "^(.*?)--", "$1/")


def snake_cache_name(namespace: Column, name: Column) -> Column:
    """The prepared-dataset folder: namespace, three underscores, name in snake case."""
    snake = F.regexp_replace(F.regexp_replace(name, r"([A-Z]+)([A-Z][a-z])", "$1_$2"), r"([a-z\d])([A-Z])", "$1_$2")
    return F.concat(namespace, F.lit("___"), F.lower(snake))


def truncated(text: Column, limit: int) -> Column:
    """At most ``limit`` characters, the last three of a cut text being dots."""
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, limit - 3), F.lit("..."))).otherwise(text)


def split_parts(spec: Column) -> tuple[Column, Column, Column]:
    """Name, first row and end of ``name[a:b]``; the whole text and nulls where it is not of that form."""
    pattern = r"^(\w+)(?:\[(\d*):(\d*)\])?$"
    fits = spec.rlike(pattern)
    bound = lambda k: F.when(fits, F.nullif(F.regexp_extract(spec, pattern, k), F.lit("")).cast("long"))
    return F.when(fits, F.regexp_extract(spec, pattern, 1)).otherwise(spec), bound(2), bound(3)


def listed_names(csv: Column) -> Column:
    """The trimmed, non-empty entries of a comma-separated list."""
    return F.filter(F.transform(F.split(csv, ","), lambda x: F.trim(x)), lambda x: x != "")


#: Retries that wait; further ones do not happen (fixed value).
MOST_RETRIES = 5


def retry_delays(factor: float, retries: int) -> list[float]:
    """Seconds before each of the first five retries at most."""
    return [factor * 2**i for i in range(min(retries, MOST_RETRIES))]


def retry_waits(failures: Column, factor: float) -> Column:
    """The seconds before each retry of a request that fails so often, as an array."""
    n = F.least(failures.cast("int"), F.lit(MOST_RETRIES))
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.lit(factor) * F.pow(F.lit(2.0), i))).otherwise(F.array().cast("array<double>"))


def valid_bucket_uri(uri: Column) -> Column:
    return uri.rlike("^s3://.+")


def valid_absolute_path(path: Column) -> Column:
    return path.rlike("^/.*")


def report_stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd_HHmmss")
