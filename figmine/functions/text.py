"""Text functions: pure Column expressions, evaluated in the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from figmine import vocab

#: all Unicode blanks, as a character class that reads the same in Java and RE2 (Java's ``\\s`` is ASCII)
BLANK = r"\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
#: the same, the quicker way in Java
_SPACE = r"[\s\x1c-\x1f]"
FIGURE_START = rf"(?i)\bFig(?:ure|\.)?[{BLANK}]+"
NUMBER = r"[-−]?\d+"
WORD3 = r"\b[a-zA-Z]{3,}\b"
#: words and blanks of ASCII alone, as RE2 has ``\\b`` and ``\\s`` (Java 17 takes all letters and digits for parts of a word)
ASCII_WORD3, ASCII_BLANK = r"(?<![0-9A-Za-z_])[a-zA-Z]{3,}(?![0-9A-Za-z_])", r"\t\n\f\r "


def strip(x: Column) -> Column:
    return F.regexp_replace(x, rf"(?U)^{_SPACE}+|{_SPACE}+$", "")


def squeeze(x: Column) -> Column:
    """Runs of blanks as one space."""
    return F.regexp_replace(x, rf"(?U){_SPACE}+", " ")


def let(x: Column, then) -> Column:
    """``then`` of a value that is computed once, however often the expression names it."""
    return F.element_at(F.transform(F.array(x), then), 1)


def clean_id(x: Column) -> Column:
    for prefix in ("arXiv:", "arxiv:", "ARXIV:"):
        x = F.regexp_replace(strip(x) if prefix == "arXiv:" else x, f"^{prefix}", "")
    return strip(x)


def valid_id(x: Column) -> Column:
    return x.rlike(r"^\d{4}\.\d{4,5}$") | x.rlike(r"^[a-z\-]+/\d{7}$")


def file_stem(x: Column) -> Column:
    return F.replace(x, F.lit("/"), F.lit("_"))


def last_dot(x: Column) -> Column:
    """0-based index of the last period, -1 where there is none."""
    return F.when(F.contains(x, F.lit(".")), F.length(x) - F.locate(".", F.reverse(x))).otherwise(F.lit(-1))


def clean_caption(raw: Column) -> Column:
    def first_sentence(t):
        sentence = F.regexp_extract(F.substring(t, 51, 1 << 30), r"(?sU)^(.*?\.)\s+[A-Z]", 1)
        return let(sentence, lambda s: F.when((F.length(t) > 50) & (s != ""), F.concat(F.left(t, F.lit(50)), s)).otherwise(t))

    def bounded(t):
        head = F.left(t, F.lit(500))
        return F.when(F.length(t) <= 500, t).when(last_dot(head) > 100, F.left(head, last_dot(head) + 1)).otherwise(F.concat(head, F.lit("...")))

    t = F.substring_index(F.regexp_extract(raw, rf"(?is)(\bFig(?:ure|\.)?[{BLANK}]+.*)$", 1), "\n\n", 1)
    t = let(let(t, first_sentence), bounded)
    for noise in (r"\s+\([a-z]\)\s*$", r"\s+\(a\)\s*\(b\)\s*\(c\)\s*$", r"\s*=\s*=\s*$", r"\s*=\s*\([a-z]\)\s*\([a-z]\)\s*=\s*$"):
        t = F.regexp_replace(t, "(?U)" + noise, "")
    t = strip(squeeze(t))
    return F.when(F.coalesce(raw, F.lit("")) == "", F.lit("")).when(raw.rlike(FIGURE_START), t).otherwise(F.left(raw, F.lit(500)))


def figure_number(caption: Column) -> Column:
    arabic = F.coalesce(*(F.nullif(F.regexp_extract(caption, p, 1), F.lit("")).try_cast("int") for p in (rf"(?i)\bFigure[{BLANK}]+(\d+)", rf"(?i)\bFig\.?[{BLANK}]+(\d+)")))
    roman = F.upper(F.regexp_extract(caption, rf"(?i)\b(?:Figure|Fig\.?)[{BLANK}]+([IVX]+)", 1))
    table = F.create_map(*(F.lit(v) for pair in vocab.ROMAN.items() for v in pair))
    return F.coalesce(arabic, F.try_element_at(table, roman))


def figure_number_simple(caption: Column) -> Column:
    """The variant without roman numerals, where the short form needs its period."""
    return F.coalesce(*(F.nullif(F.regexp_extract(caption, p, 1), F.lit("")).try_cast("int") for p in (rf"(?i)Figure[{BLANK}]+(\d+)", rf"(?i)Fig\.[{BLANK}]*(\d+)")))


PREFIX = rf"(?i)^([{BLANK}]*(?:Figure|Fig\.?)[{BLANK}]+\d+[a-z]?(?:\([a-z]\))?(?:-[a-z])?[:.{BLANK}]+|[{BLANK}]*(?:Figure|Fig\.?)[{BLANK}]+[IVX]+[:.{BLANK}]+)"


def remove_figure_prefix(text: Column, start: Column, end: Column) -> Column:
    prefix = F.regexp_extract(text, PREFIX, 1)
    rest = F.substring(text, F.length(prefix) + 1, F.length(text))
    cleaned = strip(rest)
    return F.when(prefix != "", F.struct(cleaned.alias("text"), (start + F.length(text) - F.length(cleaned)).cast("long").alias("start"), end.cast("long").alias("end"))).otherwise(
        F.struct(text.alias("text"), start.cast("long").alias("start"), end.cast("long").alias("end")))


def normalize_gate_ocr(x: Column) -> Column:
    for a, b in (("†", "DG"), ("√", "SQRT"), ("DAG", "DG")):
        x = F.replace(strip(F.upper(x)) if a == "†" else x, F.lit(a), F.lit(b))
    return F.replace(F.translate(strip(F.regexp_replace(x, r"\([^)]+\)", "")), "01", "OI"), F.lit(" "), F.lit(""))


def normalize_gates(gates: Column, names: dict | None = None) -> Column:
    known = F.create_map(*(F.lit(v) for pair in (names or vocab.GATE_NAMES).items() for v in pair))
    aliases = F.create_map(*(F.lit(v) for pair in vocab.GATE_ALIASES.items() for v in pair))

    def one(g):
        up = F.upper(strip(g))
        return F.coalesce(F.try_element_at(known, F.lower(up)), F.try_element_at(aliases, up), up)

    return F.array_distinct(F.transform(gates, one))


def normalize_text(x: Column) -> Column:
    return strip(squeeze(F.lower(x)))


def combine_text(*parts: Column) -> Column:
    return strip(F.concat_ws(" ", *(F.coalesce(p, F.lit("")) for p in parts)))


def truncate_sentence(x: Column, limit: int, least_dot: int, least_space: int | None = None) -> Column:
    head = F.left(x, F.lit(limit))
    dot = last_dot(head)
    space = F.when(F.contains(head, F.lit(" ")), F.length(head) - F.locate(" ", F.reverse(head))).otherwise(F.lit(-1))
    cut = F.when(dot > least_dot, F.left(head, dot + 1))
    if least_space is not None:
        cut = cut.when(space > least_space, F.concat(F.left(head, space), F.lit("...")))
    return F.when(F.length(x) <= limit, x).otherwise(cut.otherwise(F.concat(head, F.lit("..."))))


def is_matrix_text(x: Column, word: str = WORD3, blank: str = BLANK) -> Column:
    solid = F.length(F.replace(x, F.lit(" "), F.lit("")))
    digits = F.length(x) - F.length(F.regexp_replace(x, NUMBER, ""))
    numbers, words = F.regexp_count(x, F.lit(NUMBER)), F.regexp_count(x, F.lit(word))
    symbols = F.regexp_count(x, F.lit(r"[=+\-−×÷√∑∏∫]"))
    matrix = (digits > solid * F.lit(0.4)) | ((numbers > 10) & (words < 5)) | ((symbols > 5) & (words < 3)) | x.rlike(rf"(?:\d+[{blank}]+){{4}}")
    return F.coalesce((F.length(x) >= 10) & (solid > 0) & matrix, F.lit(False))


def _literals(pattern: str) -> list[str] | None:
    """The texts that a pattern of plain words can match (an optional space gives two), or None."""
    plain = pattern.replace(r"\b", "")
    out = [plain.replace(" ?", " "), plain.replace(" ?", "")] if " ?" in plain else [plain]
    return out if all(c.isalnum() or c == " " for t in out for c in t) else None


def pattern_hit(low: Column, pattern: str) -> Column:
    """Whether a pattern matches: the regular expression runs only on texts that contain its words."""
    words = _literals(pattern)
    found = low.rlike(pattern)
    return found if words is None else reduce(lambda a, b: a | b, (F.contains(low, F.lit(w)) for w in words)) & found


def pattern_hits(x: Column, patterns) -> Column:
    """First match text of each pattern that matches, in list order."""
    each = lambda low: F.array(*(F.when(pattern_hit(low, p), F.regexp_extract(low, p if "(" in p else f"({p})", 1)) for p in patterns))
    return F.array_compact(let(F.lower(x), each))


def caption_decision(caption: Column, accept=vocab.ACCEPT_PATTERNS, reject=vocab.REJECT_PATTERNS) -> Column:
    """REJECT before ACCEPT before PASS, without the list of matches."""
    low = F.lower(caption)
    any_ = lambda patterns: reduce(lambda a, b: a | b, (pattern_hit(low, p) for p in patterns))
    return F.when(any_(reject), "REJECT").when(any_(accept), "ACCEPT").otherwise("PASS")


def caption_filter(caption: Column, accept=vocab.ACCEPT_PATTERNS, reject=vocab.REJECT_PATTERNS) -> Column:
    decision = caption_decision(caption, accept, reject)
    matched = F.when(decision == "REJECT", pattern_hits(caption, reject)).when(decision == "ACCEPT", pattern_hits(caption, accept)).otherwise(F.array().cast("array<string>"))
    return F.struct(decision.alias("decision"), F.when(decision == "PASS", "LOW").otherwise("HIGH").alias("confidence"), matched.alias("matched"))


def first_label(text: Column, pairs) -> Column:
    """Label of the first keyword, in order, that the text contains."""
    return F.coalesce(*(F.when(F.contains(text, F.lit(k)), F.lit(v)) for k, v in pairs), F.lit(None).cast("string"))


def phrase_topic(text: Column, topics=vocab.TOPIC_PHRASES) -> Column:
    none = F.struct(F.lit("Unknown").alias("category"), F.lit(None).cast("string").alias("phrase"))
    pick = lambda low: F.coalesce(*(F.when(F.contains(low, F.lit(p)), F.struct(F.lit(c).alias("category"), F.lit(p).alias("phrase"))) for c, ps in topics for p in ps), none)
    return let(normalize_text(text), pick)


def algorithm_label(caption: Column, surrounding: Column, keywords: Column) -> Column:
    low = F.lower(F.concat_ws(" ", F.coalesce(caption, F.lit("")), F.coalesce(surrounding, F.lit(""))))
    table = F.create_map(*(F.lit(v) for pair in vocab.ALGORITHMS for v in pair))
    exact = F.try_element_at(F.filter(F.transform(keywords, lambda k: F.try_element_at(table, F.lower(k))), lambda v: v.isNotNull()), F.lit(1))
    return let(low, lambda t: F.coalesce(first_label(t, vocab.ALGORITHMS), exact, first_label(t, vocab.FALLBACK_PROBLEMS), F.lit("Unknown")))


def text_gates(page_text: Column) -> Column:
    return F.array_compact(F.array(*(F.when(page_text.rlike("(?i)" + p), F.lit(g)) for p, g in vocab.TEXT_GATES)))


def gate_tier(gate: Column) -> Column:
    return F.when(gate.isin(*vocab.HIGH_GATES), "high").when(gate.isin(*vocab.MEDIUM_GATES), "medium").otherwise("low")


def gate_validation(gates: Column) -> Column:
    allowed, control = (F.array(*map(F.lit, v)) for v in (vocab.OUTPUT_GATES, vocab.CONTROL_GATES))
    some, has_control, unique = F.size(gates) > 0, F.arrays_overlap(gates, control), F.size(F.array_distinct(gates))
    has_known = F.arrays_overlap(gates, allowed)
    confidence = F.least(F.lit(1.0), F.round(F.lit(0.6) + F.when(has_control, 0.2).otherwise(0.0) + F.when(unique >= 3, 0.1).otherwise(0.0) + F.when(F.size(gates) >= 4, 0.1).otherwise(0.0), 6))
    reason = F.when(has_control & (unique >= 3), "valid_multi_qubit_circuit").when(has_known & (unique >= 2), "valid_quantum_circuit").otherwise("borderline_circuit")
    return F.struct(
        (some & has_known).alias("ok"),
        F.when(~some, 0.0).when(~has_known, 0.3).otherwise(confidence).alias("confidence"),
        F.when(~some, "no_gates_found").when(~has_known, "no_quantum_specific_gates").otherwise(reason).alias("reason"))


def figure_references(full_text: Column, n: Column) -> Column:
    """At most five sentences that mention figure n, pattern by pattern.  A match can only begin where a
    sentence does; saying so keeps the search linear in texts without full stops."""
    n = n.cast("string")
    forms = ((f"[^.]*Figure[{BLANK}]+", "\\b[^.]*\\."), (f"[^.]*Fig\\.[{BLANK}]*", "\\b[^.]*\\."), (f"[^.]*shown in Fig\\.[{BLANK}]*", "[^.]*\\."), (f"[^.]*illustrated in Figure[{BLANK}]+", "[^.]*\\."))
    found = F.concat(*(F.regexp_extract_all(full_text, F.concat(F.lit("(?i)(?<![^.])" + a), n, F.lit(b)), F.lit(0)) for a, b in forms))
    return limit_references(F.filter(F.transform(found, strip), lambda t: sane_reference(t, n)))


def sane_reference(text: Column, n: Column) -> Column:
    """Not over 500 characters, which is a parsing error, and not the bare name of the figure."""
    bare = F.concat(F.lit(f"(?i)^Figure[{BLANK}]+"), n.cast("string"), F.lit(f"[{BLANK}]*[:.]?[{BLANK}]*$"))
    return (F.length(text) <= 500) & ~F.regexp_like(text, bare)


def limit_references(found: Column, most: int = 5) -> Column:
    return F.slice(found, 1, most)


def descriptions(caption: Column, surrounding: Column, references: Column, full: Column) -> Column:
    """``text, start, end`` of the caption, the surrounding text and the references (an array of the same
    struct), each text once, in this order.  Texts that the full text does not hold are at (0, 0)."""
    def part(x):
        place = text_position(full, strip(x))
        at = lambda side: F.coalesce(place[side], F.lit(0)).alias(side)
        return F.struct(strip(x).alias("text"), at("start"), at("end"))

    named = F.array(*(F.when(F.coalesce(strip(x), F.lit("")) != "", part(x)) for x in (caption, surrounding)))
    found = F.concat(F.array_compact(named), F.coalesce(references, F.array().cast("array<struct<text:string,start:int,end:int>>")))
    return F.filter(found, lambda d, i: ~F.exists(F.slice(found, F.lit(1), i), lambda e: e["text"] == d["text"]))


def text_position(full: Column, part: Column) -> Column:
    """(start, end) of a part in a text: exact, with blanks normalised, with flexible blanks, or by
    its first 50 characters.  Lengths count code points."""
    clean = strip(squeeze(part))
    escape = lambda x: F.regexp_replace(F.regexp_replace(x, r"([^a-zA-Z0-9_ ])", r"\\$1"), " ", r"\\s+")
    flexible = lambda x: F.regexp_substr(full, F.concat(F.lit("(?iuU)"), escape(x)))
    span = lambda start, end: F.struct(start.cast("int").alias("start"), end.cast("int").alias("end"))
    exact, squeezed = F.instr(full, part), F.instr(full, clean)
    loose, head = flexible(clean), flexible(F.left(clean, F.lit(50)))
    where = F.instr(full, loose) - 1
    start = F.instr(full, head) - 1
    return (F.when((F.coalesce(part, F.lit("")) == "") | (F.coalesce(full, F.lit("")) == ""), F.lit(None))
            .when(exact > 0, span(exact - 1, exact - 1 + F.length(part)))
            .when(squeezed > 0, span(squeezed - 1, squeezed - 1 + F.length(clean)))
            .when(loose.isNotNull(), span(where, where + F.length(loose)))
            .when((F.length(clean) > 50) & head.isNotNull(), span(start, F.least(start + F.length(clean), F.length(full)))))
