"""Scalar text functions as column expressions; all stay inside the JVM.

Patterns use the syntax that Java and RE2 share. White space and word characters are
ASCII, and case folding is by ``lower``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNIT = "\x1f"  # between the parts of an id's seed
MARKDOWN = r"\*\*|__|##+|[-*]\s"
PASSAGE_CHARS, PASSAGE_WORDS, PASSAGE_STEP = 15_000, 2_500, 2_250

# The first cue that occurs in the lower-cased text names the thought's type.
THOUGHT_CUES = [
    ("decision", "decision"), ("decide", "decision"), ("plan", "plan"), ("goal", "goal"), ("principle", "principle"), ("architecture", "architecture"),
    ("strategy", "strategy"), ("framework", "framework"), ("question", "question"), ("?", "question"), ("critique", "critique"), ("vision", "vision"),
    ("invention", "invention"), ("business", "business"), ("correct", "correction"),
]
# Typographic characters and what stands for each.
TYPOGRAPHY = ("“”‘’–— ", "\"\"''-- ")


def cases(pairs, default) -> Column:
    """CASE over (condition, value) pairs; the first that holds wins."""
    out = None
    for condition, value in pairs:
        out = F.when(condition, value) if out is None else out.when(condition, value)
    return out.otherwise(default) if out is not None else F.lit(default)


def collapse(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def normalize_words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.regexp_replace(text, MARKDOWN, " ")), F.lit("[a-z0-9']+"), F.lit(0))


def normalized_key(text: Column) -> Column:
    return F.array_join(F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0)), " ")


def normalize_for_reuse(text: Column) -> Column:
    plain = F.regexp_replace(F.regexp_replace(F.translate(text, *TYPOGRAPHY), "…", "..."), "[™®©]", "")
    return F.lower(F.regexp_replace(F.regexp_replace(plain, MARKDOWN, " "), r"[ \t]+", " "))


def scan_words(text: Column) -> Column:
    """Words for scans: what isn't a-z, 0-9 or a space in the lower-cased text parts them."""
    return F.filter(F.split(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9 ]+", " "), " +"), lambda w: w != "")


def ascii_json(json: Column) -> Column:
    """JSON with what isn't printable ASCII as escapes of four lower-case hexadecimal digits, two for one beyond the first plane."""
    units = lambda c: F.lower(F.hex(F.encode(c, "UTF-16BE")))
    escape = lambda h: F.concat(F.lit("\\u"), F.substring(h, 1, 4), F.when(F.length(h) > 4, F.concat(F.lit("\\u"), F.substring(h, 5, 4))).otherwise(""))
    # An escape is one token, so that a backslash of its own isn't taken for the beginning of another.
    tokens = F.regexp_extract_all(json, F.lit(r"(?s)\\u[0-9A-Fa-f]{4}|\\.|."), F.lit(0))
    plain = F.transform(tokens, lambda t: F.when(F.startswith(t, F.lit("\\u")) & (F.length(t) == 6), F.lower(t)).when((F.octet_length(t) > F.length(t)) | (t == "\x7f"), escape(units(t))).otherwise(t))
    return F.when(F.rlike(json, F.lit(r"[^\x00-\x7E]|\\u")), F.array_join(plain, "")).otherwise(json)


def shingle_key(shingle: Column) -> Column:
    """A shingle's CRC-32, for indexes that hold keys of 32 bits."""
    return F.crc32(shingle.cast("binary"))


def boilerplate_penalty(shingles: Column) -> Column:
    """How often a shingle occurs on average: 1 without repeats; null without shingles."""
    return F.try_divide(F.size(shingles), F.size(F.array_distinct(shingles)))


def length_ratio(a: Column, b: Column) -> Column:
    """The shorter's share of the longer (null for two empty ones)."""
    return F.try_divide(F.least(a, b), F.greatest(a, b))


def yaml_value(value: Column, escaped: bool = False) -> Column:
    """A front matter's value: quoted where it holds a special character, begins with a space or dash or is empty; ``escaped`` as JSON does."""
    quote = F.regexp_replace(F.to_json(F.struct(value.alias("x"))), r"\A\{\"x\":|\}\z", "") if escaped else F.concat(F.lit('"'), value, F.lit('"'))
    unsafe = value.rlike(r"[:#{}\[\],&*?|><!%@`\"']") | value.rlike(r"\A[ -]") | ((value == "") if escaped else F.lit(False))
    return F.when(unsafe, quote).otherwise(value)


def shingles(words: Column, k: int) -> Column:
    """Joined k-word shingles in order; none with fewer words."""
    made = F.transform(F.sequence(F.lit(0), F.size(words) - k), lambda i: F.array_join(F.slice(words, i + 1, k), " "))
    return F.when(F.size(words) >= k, made).otherwise(F.array().cast("array<string>"))


def shingles_of_hashes(h: Column, k: int) -> Column:
    """The 64-bit hashes of k words each, in order, from words' own; ``h`` must be one of the row's columns, or a variable.

    Neighbours are put together two by two, then four by four and so on, so that a place
    costs as many hashes as ``k`` has digits, not ``k`` words.
    """
    n = F.size(h)
    # Each array as a variable, or it would be made anew wherever it is named.
    bound = lambda x, f: F.element_at(F.transform(F.array(x), f), 1)
    # Hashes of runs of words and of those that follow them, of ``of`` words together.
    joined = lambda x, y, at, of: F.zip_with(F.slice(x, F.lit(1), n - of + 1), F.slice(y, F.lit(at + 1), n - of + 1), lambda a, b: F.xxhash64(a, b))

    def longer(level: Column, size: int, made: Column | None, used: int) -> Column:
        if not k & size:
            return doubled(level, size, made, used)
        more = level if made is None else joined(made, level, used, used + size)
        if used + size == k:
            return more
        return doubled(level, size, more, size) if made is None else bound(more, lambda m: doubled(level, size, m, used + size))

    def doubled(level: Column, size: int, made: Column | None, used: int) -> Column:
        return bound(joined(level, level, size, 2 * size), lambda x: longer(x, 2 * size, made, used))

    return F.when(n >= k, longer(h, 1, None, 0)).otherwise(F.array().cast("array<bigint>"))


def hashed_words(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def hashed_shingles(words: Column, k: int) -> Column:
    """64-bit hashes of the k-word shingles in order, equal where the words are: a word is hashed once, and a shingle as its words' hashes."""
    # In an array of one, as the hashes would be made anew for each shingle.
    return F.element_at(F.transform(F.array(hashed_words(words)), lambda h: shingles_of_hashes(h, k)), 1)


def passages(text: Column, words: Column) -> Column:
    """array<struct<idx, words>>: windows of long texts, overlapping, else the whole."""
    starts = F.sequence(F.lit(0), F.size(words) - 1, F.lit(PASSAGE_STEP))
    cut = F.transform(starts, lambda s: F.struct((s / PASSAGE_STEP).cast("int").alias("idx"), F.slice(words, s + 1, PASSAGE_WORDS).alias("words")))
    whole = F.array(F.struct(F.lit(0).alias("idx"), words.alias("words")))
    return F.when((F.char_length(text) > PASSAGE_CHARS) & (F.size(words) > 0), cut).otherwise(whole)


def summary(text: Column) -> Column:
    clean = collapse(text)
    sentence = F.regexp_extract(clean, r"^(.*?[.!?])\s", 1)
    return F.trim(F.substring(F.when(sentence != "", sentence).otherwise(clean), 1, 160))


def safe_title(text: Column) -> Column:
    title = F.regexp_replace(F.regexp_replace(summary(text), r"^[# \-]+", ""), r"[# \-]+$", "")
    return F.substring(F.when(title != "", title).otherwise("Untitled Extracted Knowledge"), 1, 80)


def thought_type(text: Column) -> Column:
    low = F.lower(text)
    return cases([(F.contains(low, F.lit(cue)), F.lit(value)) for cue, value in THOUGHT_CUES], "observation")


def originator(role: Column, principal: str = "principal") -> Column:
    return cases([(role == "user", F.lit(principal)), (role == "assistant", F.lit("assistant"))], "unknown")


def role_class(role: Column) -> Column:
    return cases([(role == "user", F.lit("D0")), (role == "assistant", F.lit("A0"))], "X0")


def role_confidence(role: Column) -> Column:
    return cases([(role == "user", F.lit(1.0)), (role == "assistant", F.lit(0.7))], 0.2)


def seed(*parts: Column | str) -> Column:
    """Parts joined by the unit separator; a null part reads None."""
    columns = [F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("None")) for p in parts]
    joined = [x for c in columns for x in (F.lit(UNIT), c)][1:]
    return F.concat(*joined)


def source_record_id(*parts: Column | str) -> Column:
    return F.concat(F.lit("srcmsg_"), F.substring(F.sha2(seed(*parts), 256), 1, 32))


def numbered_id(prefix: str, of: Column, digits: int = 7) -> Column:
    """A letter and seven digits: the hash's first 48 bits modulo ten million."""
    number = F.conv(F.substring(F.sha2(of, 256), 1, 12), 16, 10).cast("bigint") % 10**digits
    return F.concat(F.lit(prefix), F.lpad(number.cast("string"), digits, "0"))


def hashed_id(prefix: str, of: Column, digits: int = 12, upper: bool = False) -> Column:
    part = F.substring(F.sha2(of, 256), 1, digits)
    return F.concat(F.lit(prefix), F.upper(part) if upper else part)


def iso_from_seconds(seconds: Column) -> Column:
    """UTC ISO text of Unix seconds, micros only where there are any; out of range: the sentinel with the raw value."""
    micros = F.round(seconds * 1_000_000).cast("bigint")
    stamp = F.timestamp_micros(micros)
    whole = F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss")
    text = F.concat(whole, F.when(micros % 1_000_000 != 0, F.date_format(stamp, ".SSSSSS")).otherwise(""), F.lit("+00:00"))
    fits = (seconds >= -62135596800) & (seconds < 253402300800)
    return F.when(seconds.isNull(), F.lit(None)).when(fits, text).otherwise(F.concat(F.lit("UNPARSEABLE_RAW:"), seconds.cast("string")))


def gap_days(later: Column, earlier: Column) -> Column:
    at = lambda c: F.unix_micros(F.try_to_timestamp(c))
    return (at(later) - at(earlier)) / F.lit(86_400_000_000.0)


def excerpt(text: Column, n: int) -> Column:
    more = F.concat(F.substring(text, 1, n), F.lit(" …["), (F.char_length(text) - n).cast("string"), F.lit(" more chars]"))
    return F.when(F.char_length(text) > n, more).otherwise(text)


def first_line(text: Column) -> Column:
    return F.substring_index(text, "\n", 1)


def quoted_spans(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit("[\"“]([^\"”]{5,})[\"”]"), F.lit(1))


def is_modified(a: Column, b: Column) -> Column:
    return collapse(F.lower(a)) != collapse(F.lower(b))


def integration_strength(n: Column) -> Column:
    return cases([(n == 0, F.lit("NONE")), (n == 1, F.lit("LOW")), (n <= 3, F.lit("MEDIUM")), (n <= 10, F.lit("HIGH"))], "VERY_HIGH")


def adoption_level(present: list[Column], superseded: Column) -> Column:
    """AD0 to AD4 by how many kinds of evidence there are, one less if superseded."""
    score = sum((p.cast("int") for p in present[1:]), present[0].cast("int")) - superseded.cast("int")
    return F.concat(F.lit("AD"), F.greatest(F.lit(0), F.least(F.lit(4), score)).cast("string"))


def overlap_class(coverage: Column) -> Column:
    return cases([(coverage >= 0.8, F.lit("exact")), (coverage >= 0.35, F.lit("near"))], "partial")


def transformation_distance(coverage: Column) -> Column:
    return cases([(coverage >= c, F.lit(f"TD{i}")) for i, c in enumerate((0.9, 0.7, 0.5, 0.3, 0.15))], "TD5")


def redact(text: Column, pattern: str, mask: str = "[REDACTED]") -> tuple[Column, Column]:
    """How many secrets there are, and the text without them."""
    return F.regexp_count(text, F.lit(pattern)), F.regexp_replace(text, pattern, mask)


def slugify(text: Column) -> Column:
    kept = F.regexp_replace(F.regexp_replace(F.trim(F.lower(text)), r"[^a-z0-9_\s-]", ""), r"[\s_]+", "-")
    slug = F.regexp_replace(F.substring(F.regexp_replace(kept, "-+", "-"), 1, 80), "^-+|-+$", "")
    return F.when(slug != "", slug).otherwise("untitled")
