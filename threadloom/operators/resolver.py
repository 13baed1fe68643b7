"""Provenance resolvers: ordered rules as CASE chains, the first that holds wins; in doubt UNRESOLVED.

A case has text, role, prev_role, opening, same_conversation, matched and total (shared
shingles of its best assistant origin, null without one), prior (whether the origin is
dated earlier). Each version is a function from columns to a struct (class, certainty,
adoption, review); layered versions start from the one before.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.functions import predicates as P
from threadloom.functions import text as T
from threadloom.functions.text import cases, first_line
from threadloom.operators import messages as M
from threadloom.operators.ordering import numbered
from threadloom.storage import stored

Rule = tuple[Column, tuple]


def _strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def _verdict(rules: list[Rule], default: tuple) -> Column:
    made = lambda v: F.struct(*(x.alias(n) if isinstance(x, Column) else F.lit(x).alias(n) for n, x in zip(("cls", "certainty", "adoption", "review"), v, strict=True)))
    return cases([(c, made(v)) for c, v in rules], made(default))


class _Case:
    """The case's columns, made when they are asked for: without a session there are none."""

    text = property(lambda _: F.col("text"))
    bare = property(lambda _: _strip(F.col("text")))
    size = property(lambda _: F.char_length("text"))
    bare_size = property(lambda _: F.char_length(_strip(F.col("text"))))
    has_origin = property(lambda _: F.col("matched").isNotNull())
    after_assistant = property(lambda _: F.coalesce(F.col("prev_role") == "assistant", F.lit(False)))
    substantial = property(lambda c: c.has_origin & (F.col("matched") * 100 >= F.greatest(F.col("total"), F.lit(1)) * 15))


C = _Case()


def adoption_v1(text: Column | None = None) -> Column:
    text = C.text if text is None else text
    bare = F.char_length(_strip(text))
    return cases([(P.holds("modification", text), F.lit("AD4")), (P.holds("approval", text), F.lit("AD3")), (P.holds("rejection", text), F.lit("AD0")), (P.holds("submission", text), F.lit("AD1")), ((bare > 50) & (F.char_length(text) >= 60), F.lit("AD1"))], "AD0")


def adoption_v2(cls: str, text: Column | None = None) -> Column:
    text = C.text if text is None else text
    if cls in ("A0", "P0"):
        return F.lit({"A0": "AD0", "P0": "AD1"}[cls])
    bare = _strip(text)
    return cases([(P.holds("modification", text), F.lit("AD4")), (P.holds("approval", bare), F.lit("AD3")), (P.holds("rejection", text), F.lit("AD0")), (P.holds("submission", text), F.lit("AD1")), (F.char_length(bare) > 50, F.lit("AD1"))], "AD0")


def adoption_v3(text: Column | None = None) -> Column:
    text = C.text if text is None else text
    bare = _strip(text)
    return cases([(C.after_assistant & P.holds("yes_but_100", bare), F.lit("AD4")), (C.after_assistant & P.holds("yes_3", bare), F.lit("AD3"))], "AD0")


def adoption_v4(text: Column | None = None) -> Column:
    text = C.text if text is None else text
    bare = _strip(text)
    return cases([(~C.after_assistant, F.lit("AD0")), (P.holds("yes_but_180", bare), F.lit("AD4")), (P.holds("yes_4", bare), F.lit("AD3")), (P.holds("ask_4", bare), F.lit("AD1"))], "AD0")


def adoption_gate5(text: Column | None = None, transformation: Column | None = None) -> Column:
    text = C.text if text is None else text
    bare = _strip(text)
    n, carried = F.char_length(bare), C.after_assistant if transformation is None else C.after_assistant | transformation
    return cases(
        [
            (P.holds("gate_reject", bare), F.lit("AD0")), (C.after_assistant & (n <= 180) & P.holds("yes_but_100", bare), F.lit("AD4")), (carried & P.holds("gate_transform", bare) & (n <= 400), F.lit("AD4")),
            (C.after_assistant & P.holds("gate_adopt", bare), F.lit("AD3")), (C.after_assistant & P.holds("gate_continue", bare), F.lit("AD1")),
        ],
        "AD0",
    )


def resolver_v1() -> Column:
    a, same = adoption_v1(), F.coalesce(F.col("same_conversation"), F.lit(False))
    strong = C.has_origin & ((F.col("matched") >= 15) | ((F.col("matched") >= 8) & (F.col("matched") * 100 >= F.greatest(F.col("total"), F.lit(1)) * 35)))
    lead = first_line(C.bare)
    carrier = (lead != "") & (P.holds("submission", lead) | P.holds("carrier_leadin", lead))
    return _verdict(
        [
            (F.col("role") == "assistant", ("A0", "PC4", "AD0", False)),
            (P.holds("rejection", C.bare) & (C.bare_size < 250), ("X0", "PC4", "AD0", False)),
            (P.external_fingerprint(C.text).isNotNull() & ~F.col("opening"), ("P0", "PC2", a, True)),
            (strong & (C.size > 200) & (F.char_length(lead) < 120) & ~carrier, ("MIXED", "PC4", a, True)),
            (strong & ~same, ("P0", "PC4", a, False)),
            (C.has_origin & same, ("P0", "PC4", a, False)),
            ((P.holds("paste_markers", C.text) | P.holds("submission", C.text)) & (C.size > 300) & ~carrier, ("MIXED", "PC3", a, True)),
            (~C.has_origin & P.roleplay_marketing(C.text), ("UNRESOLVED", "PC1", a, True)),
            (F.col("opening") & (C.size < 200) & ~P.holds("structured", C.text), ("D0", "PC4", "AD0", False)),
            ((C.size < 200) & ~P.holds("structured", C.text) & ~P.holds("paste_markers", C.text), ("D0", "PC3", a, False)),
            (P.holds("structured", C.text) & ~C.has_origin, ("D0", "PC1", a, True)),
            (P.holds("weak", C.text) | ((C.size > 300) & ~F.col("opening") & ~C.has_origin), ("UNRESOLVED", "PC1", a, True)),
        ],
        ("D0", "PC2", a, False),
    )


def resolver_v2() -> Column:
    same = F.coalesce(F.col("same_conversation"), F.lit(False))
    total = F.greatest(F.col("total"), F.lit(1))
    strong = C.has_origin & F.when(same, (F.col("matched") >= 2) & (F.col("matched") * 100 >= total * 15)).otherwise((F.col("matched") >= 3) & (F.col("matched") * 100 >= total * 20))
    lead = F.char_length(first_line(C.bare))
    structured = P.holds("structured", C.text)
    numbered = (P.holds("pros", C.bare) & P.holds("cons", C.bare)) | P.holds("listicle", C.bare)
    fingerprint = numbered | P.holds("narrative", C.bare)
    return _verdict(
        [
            (F.col("role") == "assistant", ("A0", "PC4", "AD0", False)),
            (P.holds("short_correction", C.bare) & (C.bare_size < 200), ("X0", "PC4", "AD0", False)),
            (fingerprint & ~F.col("opening"), ("P0", "PC2", "AD1", True)),
            (strong & (C.size > 200) & lead.between(10, 150), ("MIXED", "PC4", adoption_v2("MIXED"), True)),
            (strong, ("P0", "PC4", "AD1", False)),
            ((P.holds("paste_markers", C.text) | P.holds("submission", C.text)) & (C.size > 300), ("MIXED", "PC3", adoption_v2("MIXED"), True)),
            (F.col("opening") & (C.bare_size < 200) & ~structured, ("D0", "PC4", adoption_v2("D0"), False)),
            ((C.bare_size < 200) & ~structured & ~P.holds("paste_markers", C.text) & ~numbered, ("D0", "PC3", adoption_v2("D0"), False)),
            ((structured | numbered | (C.size > 200)) & C.has_origin & same, ("P0", "PC3", "AD1", True)),
        ],
        ("UNRESOLVED", "PC1", adoption_v2("UNRESOLVED"), True),
    )



def resolver_v3(mixed: bool = True) -> Column:
    """``mixed=False`` gives the class below the mixed flag."""
    external = P.external_fingerprint(C.text).isNotNull()
    control = (F.col("role") == "user") & C.after_assistant & (C.bare_size <= 180) & P.holds("control_act", C.bare) & ~F.contains(C.bare, F.lit("\n\n"))
    flag = C.substantial & (C.size > 80) & P.holds("mixed_lead", C.text)
    rules = [(F.col("role") == "assistant", ("A0", "PC4", "AD0", False))] + ([(flag, ("MIXED", "PC3", "AD0", True))] if mixed else [])
    return _verdict(rules + [(C.substantial, ("P0", "PC4", adoption_v3(), False)), (external, ("P0", "PC4", "AD0", False)), (control, ("D0", "PC3", adoption_v3(), False))], ("UNRESOLVED", "PC0", "AD0", True))


def _boundary() -> Column:
    """Places before the first blank line, else the first line feed (null: none)."""
    at = lambda x: F.nullif(F.instr(C.text, x), F.lit(0)) - 1
    return F.coalesce(at("\n\n"), at("\n"))


def _imported_lead() -> Column:
    """What stands before imported text, with the line that announces it; empty without."""
    heads = [F.regexp_extract("text", p, 1) for p in P.IMPORT_BOUNDARIES]
    return cases([(F.char_length(h).between(5, C.size - 21), h) for h in heads], "")


def _first_cut() -> Column:
    at = lambda x: F.when(F.instr(C.text, x) - 1 >= 5, F.instr(C.text, x) - 1)
    return F.least(at("\n\n"), at("  "), at(":"))


def resolver_v4(base: str = "v3") -> Column:
    """On a column with v3's verdict."""
    b = F.col(base)
    cut, first = _boundary(), _first_cut()
    lead = _imported_lead()
    wrapped = lead != ""
    carrier = P.holds("carrier_prefix", C.text)
    split = wrapped | (carrier & cut.between(5, 300) & (C.size - cut > 40))
    prior = C.substantial & F.coalesce(F.col("prior"), F.lit(False))
    lead_adoption = F.when(wrapped, adoption_v4(lead)).otherwise(adoption_v4(F.expr("substring(text, 1, coalesce(nullif(instr(text, '\n\n'), 0), nullif(instr(text, '\n'), 0)) - 1)")))
    return _verdict(
        [
            (b["cls"].isin("D0", "A0"), (b["cls"], b["certainty"], b["adoption"], b["review"])),
            (split, ("MIXED", b["certainty"], lead_adoption, True)),
            (prior & carrier & (first <= 300) & (C.size - first > 30), ("MIXED", b["certainty"], b["adoption"], True)),
            (prior, ("P0", b["certainty"], adoption_v4(), False)),
            (P.holds("import_markers", C.text), ("UNRESOLVED", b["certainty"], b["adoption"], True)),
        ],
        (b["cls"], b["certainty"], b["adoption"], b["review"]),
    )


def resolver_gate5(base: str = "v3", plain: str = "v3_plain") -> Column:
    """On columns with v3's verdict, with the mixed flag and without."""
    b, p = F.col(base), F.col(plain)
    lead = first_line(C.bare)
    wrap = P.holds("transcript_below", C.bare)
    transform = C.has_origin & (F.col("matched") * 10 >= F.greatest(F.col("total"), F.lit(1)) * 8) & (F.char_length(lead) <= 160) & P.holds("transform_lead", lead) & (C.bare_size > 250)
    before = F.expr("substring(text, 1, instr(lower(text), 'the entire transcript is given below') - 1)")
    lead_text = F.when(wrap, before).otherwise(lead)
    under = F.when(b["cls"] == "MIXED", p).otherwise(b)
    return _verdict(
        [
            (b["cls"].isin("D0", "A0"), (b["cls"], b["certainty"], b["adoption"], b["review"])),
            (wrap | transform, ("MIXED", "PC3", adoption_gate5(lead_text, P.holds("gate_transform", _strip(lead_text))), True)),
            (under["cls"].isin("P0", "UNRESOLVED"), (under["cls"], under["certainty"], adoption_gate5(), under["review"])),
        ],
        (under["cls"], under["certainty"], under["adoption"], under["review"]),
    )


def resolver_v5(base: str = "v4") -> Column:
    b = F.col(base)
    first = _first_cut()
    prior = C.substantial & F.coalesce(F.col("prior"), F.lit(False))
    material = P.holds("material_transformation", C.text)
    return _verdict(
        [
            (b["cls"].isin("D0", "A0"), (b["cls"], b["certainty"], b["adoption"], b["review"])),
            (P.holds("correction_of_supplied", C.text), ("UNRESOLVED", b["certainty"], b["adoption"], True)),
            (prior & P.holds("traceable_carrier", C.text) & (first <= 300) & (C.size - first > 30), ("MIXED", b["certainty"], F.when(material, "AD4").otherwise(b["adoption"]), True)),
            (material, (b["cls"], b["certainty"], "AD4", b["review"])),
        ],
        (b["cls"], b["certainty"], b["adoption"], b["review"]),
    )


def resolver_v6(base: str = "v5") -> Column:
    b = F.col(base)
    cut = _boundary()
    body = cut.between(5, 300) & (C.size - cut > 40)
    lead = F.when(cut.between(5, 300), F.expr("substring(text, 1, coalesce(nullif(instr(text, '\n\n'), 0), nullif(instr(text, '\n'), 0)) - 1)")).otherwise("")
    prior = C.substantial & F.coalesce(F.col("prior"), F.lit(False))
    marked = P.holds("external_markers", C.text)
    demoted = cases([(P.holds("transcript_template", C.text), F.lit("AD3")), (P.holds("transform_hint", C.text), F.lit("AD4")), (P.holds("style_carrier", C.text), F.lit("AD2"))], b["adoption"])
    carried = P.holds("transcript_template", C.text) | P.holds("style_carrier", lead) | P.holds("paste_markers", C.text) | P.holds("submission", C.text) | P.holds("structured", C.text)
    directive = (C.bare_size <= 400) & ~F.contains(C.bare, F.lit("\n\n")) & ~marked & P.holds("directive", C.bare)
    mixed = b["cls"] == "MIXED"
    return _verdict(
        [
            (mixed & P.holds("own_artifact", C.text), ("UNRESOLVED", b["certainty"], b["adoption"], True)),
            (mixed & (P.holds("substantive", lead) | P.holds("thread", C.text)), (b["cls"], b["certainty"], b["adoption"], b["review"])),
            (mixed & ((body & carried) | marked | P.external_fingerprint(C.text).isNotNull()), ("P0", b["certainty"], demoted, ~prior)),
            (mixed, ("UNRESOLVED", b["certainty"], b["adoption"], True)),
            ((b["cls"] == "P0") & directive, ("UNRESOLVED", b["certainty"], b["adoption"], True)),
        ],
        (b["cls"], b["certainty"], b["adoption"], b["review"]),
    )


VERSIONS: dict[str, Callable[[], Column]] = {"v1": resolver_v1, "v2": resolver_v2, "v3": resolver_v3, "v3_plain": lambda: resolver_v3(False), "v4": resolver_v4, "gate5": resolver_gate5, "v5": resolver_v5, "v6": resolver_v6}


def resolve(cases_: DataFrame) -> DataFrame:
    """``cases_`` with a verdict column for each version."""
    out = cases_
    for name, rule in VERSIONS.items():
        out = out.withColumn(name, rule())
    return out


def page_class(matches: Column, by_principal: Column) -> Column:
    """What a wiki page's overlap with earlier assistant text makes of it."""
    return cases([((matches >= 20) & by_principal, F.lit("REUSE")), (matches >= 20, F.lit("A0_CANDIDATE")), (matches >= 3, F.lit("WEAK"))], "NO_ORIGIN")


def build_cases(messages: DataFrame, k: int = 12, least_chars: int = 100) -> DataFrame:
    """A resolver's case for each message, from its reuse of assistants' texts and its neighbours.

    A shingle belongs to the first assistant's message (in scan order) of ``least_chars`` that has
    it. The best origin of a person's message has most of its shingles, repeats counted; ties go
    to the smaller conversation, then id. Adds origin_id, n_origins, gap_days and what
    ``resolve`` asks for.
    """
    place = ["source_file", "conversation_id", "ts", "canonical_id"]
    words = messages.select(*place, "role", F.char_length("text").alias("size"), T.normalize_words(F.col("text")).alias("words"))
    # Written once, as three steps ask for the shingles, which cost far more than the rest.
    every = stored(words.select(*place, "role", "size", T.hashed_shingles(F.col("words"), k).alias("s"), F.monotonically_increasing_id().alias("mid")), "case-shingles")
    origin = every.where((F.col("role") == "assistant") & (F.col("size") >= least_chars))
    # Places go as numbers in scan order, one number a shingle and not five texts.
    at = stored(numbered(origin.select(*place).distinct(), [F.col("source_file"), F.col("conversation_id"), F.coalesce("ts", F.lit("")), F.col("canonical_id"), F.col("ts")], name="o"), "case-places")
    same = [origin[c].eqNullSafe(at[c]) for c in place]
    first = origin.join(at, same).select("o", F.explode("s").alias("sh")).groupBy("sh").agg(F.min("o").alias("o"))
    # Repeats are counted before the join: one row a message and shingle, where shingles lie together already.
    asked = every.where("role = 'user'").select("mid", F.explode("s").alias("sh")).repartition("sh").groupBy("mid", "sh").agg(F.count("*").alias("times"))
    counts = asked.join(first, "sh").groupBy("mid", "o").agg(F.sum("times").alias("matched"))
    rank = F.struct((-F.col("matched")).alias("m"), F.col("conversation_id").alias("c"), F.col("canonical_id").alias("i"), F.col("ts").alias("t"))
    best = counts.join(at, "o").groupBy("mid").agg(F.min(rank).alias("best"), F.count("*").alias("n_origins"))
    joined = M.neighbours(messages).join(every.select("canonical_id", "mid", F.size("s").alias("n")).join(best, "mid", "left"), "canonical_id")
    gap = F.abs(T.gap_days(F.col("ts"), F.col("best.t")))
    return joined.select(
        "canonical_id", "conversation_id", "text", "role", "prev_role", (F.col("turn") <= 1).alias("opening"), (-F.col("best.m")).cast("int").alias("matched"), F.greatest("n", F.lit(1)).alias("total"),
        F.when(F.col("best").isNotNull(), F.col("best.c") == F.col("conversation_id")).alias("same_conversation"), F.when(F.col("best").isNotNull(), F.coalesce(F.col("best.t") < F.col("ts"), F.lit(False))).alias("prior"),
        F.col("best.i").alias("origin_id"), F.coalesce("n_origins", F.lit(0)).alias("n_origins"), gap.alias("gap_days"),
    )


SPAN = "array<struct<start:int, end:int, author:string, cls:string, source:string, tier:string>>"


def spans(origin: Column | None = None) -> Column:
    """The two parts of a text of mixed authorship, after an announced import, a carrier or a traceable one; none if it can't be cut."""
    origin = F.lit(None).cast("string") if origin is None else origin

    def cut(at: Column, author: str, tier: str) -> Column:
        part = lambda a, b, who, cls, source, t: F.struct(a.cast("int").alias("start"), b.cast("int").alias("end"), F.lit(who).alias("author"), F.lit(cls).alias("cls"), source.alias("source"), F.lit(t).alias("tier"))
        return F.array(part(F.lit(0), at, "principal", "D0", F.lit(None).cast("string"), "DAE-3"), part(at, C.size, author, "P0", origin, tier))

    lead, boundary, first = F.char_length(_imported_lead()), _boundary(), _first_cut()
    carrier = P.holds("carrier_prefix", C.text)
    prior = C.substantial & F.coalesce(F.col("prior"), F.lit(False))
    rules = [
        (lead > 0, cut(lead, "external", "P0-PROBABLE")), (carrier & boundary.between(5, 300) & (C.size - boundary > 40), cut(boundary, "unknown", "P0-PROBABLE")),
        (prior & carrier & (first <= 300) & (C.size - first > 30), cut(first, "assistant", "P0-CERTAIN")),
    ]
    return cases(rules, F.array().cast(SPAN))


def segments() -> Column:
    """struct(proposed, reason, commentary, pasted): whether a text with reuse or paste marks falls in the person's lead and what was pasted."""
    reused, pasted = F.coalesce(F.col("matched") >= 3, F.lit(False)), P.holds("paste_markers", C.text)
    at = _boundary()
    lead, rest = _strip(F.substring(C.text, F.lit(1), at)), _strip(F.substring(C.text, at + 1, C.size))
    made = lambda proposed, reason, a=F.lit(None), b=F.lit(None): F.struct(F.lit(proposed).alias("proposed"), F.lit(reason).alias("reason"), a.cast("string").alias("commentary"), b.cast("string").alias("pasted"))
    return cases(
        [
            (~(reused | pasted), made(False, "no evidence")), (at.isNull(), made(False, "no boundary")), ((F.char_length(lead) < 10) | (F.char_length(rest) < 50), made(False, "a span is too short")),
            (reused, made(True, "reuse", lead, rest)),
        ],
        made(True, "paste markers", lead, rest),
    )


def p0_status(version: str) -> Column:
    """How sure it is that a verdict's text is from outside: certain with a dated earlier origin, else probable; null for the person's own."""
    b = F.col(version)
    prior = C.substantial & F.coalesce(F.col("prior"), F.lit(False))
    return F.when(b["cls"].isin("P0", "MIXED"), F.when(prior, "P0-CERTAIN").otherwise("P0-PROBABLE")).when(b["cls"] == "UNRESOLVED", "P0-UNRESOLVED")
