"""Predicates over message texts: one pattern each, for Java and RE2 alike."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Search patterns. Those that begin with \A hold at the start of the stripped text.
PATTERNS = {
    "paste_markers": r"(?im)(unsubscribe|privacy\s+policy|sent\s+from\s+my\s+|sent\s+to:\s+|^best,?\s*$|^regards,?\s*$|^\d{1,4}\s+[a-z0-9 .]+(street|st\.?|ave\.?|road|rd\.?|blvd|drive|dr\.?|lane|ln\.?|court|ct\.?|way|circle|plaza|building|suite|#)\b|@\w+\.(com|net|org|io|co|info)\b)",
    "submission": r"(?i)(add this (to|in)|what do you think of this|here'?s (the|my|a) (text|bio|profile|article|draft|resume|cv|post)|can you (improve|fix|enhance|edit|review|rewrite) this|i (found|got) this|someone sent me|from my other (chat|conversation|thread)|same thing (for|as)|do the same thing|recreate this|make it like this|similar to this)",
    "approval": r"(?i)\A\s*(yes[,!.]?|yep|yeah|love it|perfect|sounds good|let'?s do (that|this)|add (that|this)|keep (that|this)|we'?re doing (that|this)|that'?s exactly it|i like (this|that)|great,? (let'?s|do it))",
    "rejection": r"(?i)\A\s*(no[,!.]|not what i|that'?s not (it|right|what)|scrap that|wrong,?|actually,? i don'?t|i don'?t (like|want) (that|this)|nevermind|never mind|that'?s not correct|remove that|delete that|undo that)",
    "modification": r"(?i)(yes,? but|love it,? (but|change|except)|keep .+ but (rename|change|call)|let'?s do this,? except|i want to (call|rename|name) (it|this)|change .+ to |instead of .+ let'?s|good,? but|don'?t (do|change|add|remove))",
    "weak": r"(?i)\A\s*(ok\.?|okay\.?|sure\.?|maybe\.?|hmm\.?|i guess\.?|not sure\.?|could be\.?|possibly\.?)\s*\z",
    "short_correction": r"(?i)\A\s*(no[,!.\s]|not what i|that'?s not (it|right|what)|scrap that|wrong,?|remove that|delete that|undo that|i don'?t want (that|this)|that'?s not correct|not (this|that)\s*\z)",
    "structured": r"(?m)(^#{1,4}\s|\*\*[^*]+\*\*|^\d+\.\s.+\n.+\n.+|\|.*\|.*\|)",
    "carrier_leadin": r"(?i)(should (something like this|this|it) be added|what do you think of (this|it))",
    "control_act": r"(?i)\A\s*(yes|yep|yeah|ok(ay)?|no|wrong|perfect|good|great|let['’]?s\s+(do|go)|i\s+(agree|approve)|that['’]?s\s+(not|right|correct)|i\s+(didn['’]?t|don['’]?t))\b",
    "carrier_prefix": r"(?is)\A.{0,240}\b(summarize|rewrite|recreate|improve|review|make this better|email below|script below|her reply|post i like|wait before we move on|is this inside the system|what can be done with these)\b",
    "import_markers": r"(?im)(https?://|^subject:|^from:\s|^sent:\s|^her reply\b|entire transcript is given below|word-for-word script transcription|```(python|bash|json|yaml|sql)?|^architecture board|^board directive|^implementation commit|^tests?\s*:\s*(pass|\d+ passed))",
    "transcript_below": r"(?i)the entire transcript is given below",
    "transcript_template": r"(?is)summarize the transcript of a youtube video .{0,300}?the entire transcript is given below",
    "traceable_carrier": r"(?is)\A\s*(can you create .{0,180}\b(email|script|prompt)\b.{0,100}\bbelow\b|create a (prompt|video hook)\b|can['’]?t we put (a limit|limits?)\b)",
    "correction_of_supplied": r"(?is)\A\s*(i (didn['’]?t|did not) say|those are not my words|you attributed .{0,80} to me incorrectly)\b",
    "material_transformation": r"(?is)\A\s*(can you create .{0,180}\bfrom (the|this) .{0,40}\bbelow\b|create a prompt for\b|recreate this with \d+ characters?\b)",
    "substantive": r"(?is)(can['’]?t we put (a limit|limits?)|\bi (want|need|['’]d like|prefer|decided)\b|\bmake (the|this) system\b|\bdon['’]?t make\b|\bremove (funding|that)\b|\b(we|i) should\b|\b(we|i) need\b|\bchange .{0,40} to\b)",
    "thread": r"(?im)^me:?\s",
    "own_artifact": r"(?i)\bmy chrome extension\b",
    "style_carrier": r"(?is)(can you (create|rewrite|write|make) .{0,140}(writing style|style of|characters please|subject line|and make it funny)|recreate this|create a prompt for|how can we make this better|wait before we move on|this is a post i like|what can be done with these|is this inside the system|her reply)",
    "transform_hint": r"(?is)(create a follow-up email|rewrite this|recreate this|create a prompt for|come up with a killer subject line)",
    "external_markers": r"(?im)(https?://|^subject:|^from:\s|^sent:\s|```(python|bash|json|yaml|sql)?|docker run|pip install|^body:|the entire transcript is given below|word-for-word script transcription|import random|import datetime|from datetime import)",
    "directive": r"(?i)\A(can|could|please|make|add|connect|do|create)\b",
    "url": r"https?://",
    "transform_lead": r"(?i)\A\s*(can\s+you\s+(create|rewrite|recreate|write|make|build|summarize)\b|(please\s+)?(create|rewrite|recreate|write|make it|summarize)\b)",
    "gate_reject": r"(?i)\A\s*(no|nope|wrong|that['’]?s\s+(not|wrong)|don['’]?t\s+(do|use|add)|never\s+(do|use|add)|remove\s+(that|it|the))\b",
    "gate_adopt": r"(?i)(\A\s*(yes|yep|yeah|perfect|approved?|exactly|that['’]?s\s+it)\b|\b(add this|use this|build this|put this in|integrate this|make this part of|include this)\b)",
    "gate_continue": r"(?i)\A\s*(what if|how about|can we also|can you also|and then|also,?)\b",
    "gate_transform": r"(?i)(\A\s*(can\s+you\s+)?(create|rewrite|recreate|write|make it|build)\b|\bbut\s+)",
    "yes_but_100": r"(?i)\A(yes|good|great).{0,100}\bbut\b",
    "yes_3": r"(?i)\A(yes|yep|yeah|perfect|approved?)\b",
    "yes_but_180": r"(?is)\A(yes|approved?|adopt).{0,180}\b(but|change|modify|add|connect|integrate)\b",
    "yes_4": r"(?i)\A(yes|approved?|perfect|use this|add this|keep this)\b",
    "ask_4": r"(?i)\A(can|could|what|how|review|summarize|rewrite|recreate)\b",
    "mixed_lead": r"(?is)\A.{1,160}(add this|use this|what can|can you|with this)",
    "pros": r"(?m)^\s*Pros?:?\s*1\.",
    "cons": r"(?m)^\s*Cons?:?\s*1\.",
    "listicle": r"(?im)^\d+\s+Things?\s+I['’]ve learned",
    "numbered_start": r"\A\d+\.\s",
    "numbered_more": r"\n\d+\.\s",
    "narrative": r"(?i)(unfair advantages i never had|odds were (pretty much )?stacked against me)",
    "roleplay": r"(?i)(act like (the|a) creator|pretend you are|walk you through the whole thing|imagine you are)",
    "agent_label": r"(?im)^from (?:codex|claude|hermes|opencode|gemini)|^codeone:",
    "tool_output": r"(?im)^(?:ps [a-z]:|traceback|listed directory|created \d+_|docker ps|memory updated)",
    "third_party": r"(?im)(1st degree connection|sent the following message|view .+ profile|her reply)",
    "web_or_transcript": r"(?im)(https?://|webinar|screen-reader|the entire transcript|\d+:\d{2} )",
    "didnt_say": r"(?i)\Ai didn.t say",
    "carrier_request": r"(?i)\A(can you rewrite|summarize|recreate)",
    "sales": r"(™|®|paid up to \$[0-9,]+|\$[0-9,]+\s+(to|for)\s+(be there|join|attend))",
}

# Lines after which imported text begins, in the order in which they are tried.
IMPORT_BOUNDARIES = [r"(?is)\A(.*?the entire transcript is given below\.[ \t]*\r?\n)", r"(?is)\A(.*?here['’]s the word-for-word script transcription[^\n]*\r?\n)", r"(?is)\A(.*?below is a single upgrade script[^\n]*\r?\n)"]
# Headers of relayed messages, and lines of extraction.
RELAY_HEADER = r"(?m)^([A-Z][A-Za-z ]{1,30}) \[\d{1,2}:\d{2} (?:AM|PM)\]"
ENTITY_LINE = r"(?im)\b(entity|person|organization|place|product|technology)\s*:\s*([^\n]+)"
RELATION_LINE = r"(?im)^[ \t]*relationship[ \t]*:[ \t]*([^\n]+)"
TIMELINE_LINE = r"(?im)^[ \t]*timeline[ \t]*:[ \t]*(\d{4}-\d{2}-\d{2})[ \t]*\|[ \t]*([a-z_]+)[ \t]*\|[ \t]*([^\n]+)"


# RE2's word border knows ASCII letters only, Java's any; its lines end with a line feed only, and its space has no vertical tab.
_BORDER = r"(?:(?<=[0-9A-Za-z_])(?![0-9A-Za-z_])|(?<![0-9A-Za-z_])(?=[0-9A-Za-z_]))"
_AS_RE2 = {r"\b": _BORDER, r"\s": r"[\t\n\f\r ]"}


def java(pattern: str) -> str:
    """``pattern`` as Java must read it to find what RE2 finds."""
    return "(?d)" + re.sub(r"\\.", lambda m: _AS_RE2.get(m.group(), m.group()), pattern)


def holds(name: str, text: Column) -> Column:
    return text.rlike(java(PATTERNS[name]))


def external_fingerprint(text: Column) -> Column:
    """What kind of outside text this looks like, or null; zero-width characters and bold marks don't count."""
    t = F.trim(F.regexp_replace(F.regexp_replace(text, "[​‌‍﻿]", ""), r"\*\*", ""))
    long = F.char_length(t) > 300
    return (
        F.when(holds("pros", t) & holds("cons", t), "product-review-format").when(holds("listicle", t), "listicle-header")
        .when(holds("numbered_start", t) & long & holds("numbered_more", t), "numbered-list-content").when(holds("narrative", t) & long, "hardship-narrative-post")
    )


def roleplay_marketing(text: Column) -> Column:
    return (F.char_length(text) >= 300) & holds("roleplay", text) & holds("sales", text)
