"""Secret scan with ownership frequency over the whole corpus.

Patterns give candidate spans (code points) in each text. The SHA-256 of each
candidate's value is counted by distinct owners and repositories: a value that
many owners carry is a copied example, one that a single owner or two carry looks
live. Only spans and hashes are shuffled, never texts. Counts are combined before
the shuffle, and the join of candidates with counts has one row a hash on one side,
so that adaptive execution may split a hash that a third of all rows carry.

All of it is DataFrame functions.

Defined results: a null text counts as empty; each input row gives one row,
repeated rows too; a null owner or repository counts as one more of its kind;
extra columns are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _either(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


# The pattern, the group with the secret, the least length of that group, and a string without which the pattern can't match (lower-cased text for assign).
ASSIGN = "(" + "|".join(map(_either, ("password", "passwd", "secret", "token", "api_?key"))) + ")[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
KINDS = {
    "assign": (ASSIGN, 2, 6),
    "access": ("AKIA[A-Z0-9]+", 0, 20),
    "hex": ("[0-9a-f]{24,}", 0, 24),  # the same spans as runs of any length, without the short ones
    "github": ("gh[opsu]_[A-Za-z0-9]{36,}", 0, 40),
    "slack": ("xox[abprs]-[A-Za-z0-9-]+", 0, 20),
    "jwt": (r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 30),
    "pem": ("-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0),
}
BASE = ("assign", "access", "hex")
SPAN = "struct<s:int,k:int,e:int,v:string>"


def _may(kind: str, text: Column, low: Column) -> Column:
    if kind == "assign":
        return low.contains("passw") | low.contains("secret") | low.contains("token") | low.contains("api")
    if kind == "hex":
        return text.rlike(KINDS["hex"][0])
    if kind == "github":
        return text.contains("gho_") | text.contains("ghp_") | text.contains("ghs_") | text.contains("ghu_")
    return text.contains({"access": "AKIA", "slack": "xox", "jwt": "eyJ", "pem": "PRIVATE KEY-----"}[kind])


def _spans(kind: str, text: Column) -> Column:
    """All leftmost matches that don't overlap, with their places: what stands between matches gives the offsets.

    Arrays grow by copying, so matches are placed within blocks of about the root of their
    number, and the blocks then: a text of very many matches takes n ** 1.5 steps at most.
    """
    pattern, group, least = KINDS[kind]
    zipped = F.arrays_zip(F.split(text, pattern, -1).alias("a"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"))
    value = lambda x: F.regexp_extract(x["v"], pattern, group)

    def step(acc, z):
        start = acc["at"] + F.char_length(z["a"])
        end = start + F.coalesce(F.char_length(z["m"]), F.lit(0))
        found = F.struct(start.alias("s"), F.lit([*KINDS].index(kind)).alias("k"), end.alias("e"), z["m"].alias("v"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(found)).alias("out"))

    placed = lambda part: F.aggregate(part, F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("out")), step)
    size = lambda z: F.greatest(F.lit(16), F.ceil(F.sqrt(F.size(z))).cast("int"))
    # Arrays of one element bind what is used more than once.
    blocks = F.flatten(F.transform(F.array(zipped), lambda z: F.transform(F.sequence(F.lit(0), F.floor((F.size(z) - 1) / size(z)).cast("int")), lambda i: placed(F.slice(z, i * size(z) + 1, size(z))))))
    begins = lambda b: F.aggregate(b, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")), lambda acc, x: F.struct((acc["at"] + x["at"]).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"])
    moved = lambda x, by: F.transform(x["out"], lambda y: F.struct((y["s"] + by).alias("s"), y["k"].alias("k"), (y["e"] + by).alias("e"), y["v"].alias("v")))
    every = F.flatten(F.flatten(F.transform(F.array(blocks), lambda b: F.zip_with(b, begins(b), moved))))
    kept = F.filter(every, lambda x: x["v"].isNotNull() & (F.char_length(value(x)) >= least))
    return F.transform(kept, lambda x: F.struct(x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e"), value(x).alias("v")))


def find_spans(text: Column) -> Column:
    """array<struct<s,k,e,v>> sorted by start, then kind; k: the kind's place in KINDS."""
    text = F.coalesce(text, F.lit(""))
    none = F.array().cast(f"array<{SPAN}>")
    return F.array_sort(F.concat(*(F.when(_may(kind, text, F.lower(text)), _spans(kind, text)).otherwise(none) for kind in KINDS)))


def spans_text(spans: Column, kinds: tuple[str, ...] = tuple(KINDS)) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    kept = F.filter(spans, lambda x: F.get(names, x["k"]).isin(*kinds))
    return F.array_join(F.transform(kept, lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner: Column | None = None, repository: Column | None = None, shared_owners: int = 3) -> DataFrame:
    """One row a document: spans (array of start, kind, end), n_live, n_shared, most_owners.

    A candidate is shared if at least ``shared_owners`` owners carry its value, else live.
    """
    owner = F.col("source") if owner is None else owner
    repository = F.concat_ws("/", F.col("source"), F.col("lang")) if repository is None else repository
    # sha2 of the value only: no secret is written to the shared folder.
    hashed = F.transform(find_spans(F.col(text_col)), lambda x: F.struct(x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e"), F.sha2(x["v"], 256).alias("h")))
    found = materialize(docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.coalesce(owner.cast("string"), F.lit("\0")).alias("owner"), F.coalesce(repository.cast("string"), F.lit("\0")).alias("repo"), hashed.alias("spans")), "secrets")
    each = found.select("row", "owner", "repo", F.explode(F.array_distinct(F.transform("spans", lambda x: x["h"]))).alias("h"))
    pairs = each.groupBy("h", "owner", "repo").agg(F.count("*").alias("files"))
    owned = pairs.groupBy("h").agg(F.count_distinct("owner").alias("owners"), F.count_distinct("repo").alias("repos"), F.sum("files").alias("files"))
    verdict = each.select("row", "h").join(owned, "h").groupBy("row").agg(
        F.count_if(F.col("owners") < shared_owners).alias("n_live"), F.count_if(F.col("owners") >= shared_owners).alias("n_shared"), F.max("owners").alias("most_owners"), F.max("repos").alias("most_repositories"),
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    return found.join(verdict, "row", "left").select(F.col("id").alias(id_col), "spans", zero("n_live"), zero("n_shared"), zero("most_owners"), zero("most_repositories"))


def redact(text: Column, mask: str = "[secret]") -> Column:
    """The text with each span's secret replaced; overlapping spans become one mask."""
    text = F.coalesce(text, F.lit(""))

    def step(acc, x):
        fresh = x["s"] >= acc["at"]
        piece = F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.greatest(x["s"] - acc["at"], F.lit(0))), F.when(fresh, F.lit(mask)).otherwise(F.lit("")))
        return F.struct(F.greatest(acc["at"], x["e"]).alias("at"), piece.alias("out"))

    cut = F.aggregate(find_spans(text), F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.char_length(text))))
    return cut
