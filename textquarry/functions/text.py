"""Row-level text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textquarry.functions.hashing import let, squeeze, uniform

SPACE = r"[ \t\n\r\f\x0B]+"
NONSPACE = r"[^ \t\n\r\f\x0B]+"

# Fixed value: the pre-tokenizer split pattern of the tokenizer this corpus is counted with.
PRETOKEN = (
    r"(?i: ?(?:[jtmslndcy]['’]|qu['’]|jusqu['’]|lorsqu['’]|puisqu['’]|quoiqu['’]|aujourd['’]hui)"
    r"|['’][stmd]|['’][rv]e|['’]ll)"
    r"| ?\p{L}+|\p{N}| ?[^\s\p{L}\p{N}]+[\r\n]*|\s*[\r\n]+|\s+(?!\S)|\s+"
)
# The same families without look-ahead, for engines that lack it.
PRETOKEN_PLAIN = r" ?\p{L}+|\p{N}| ?[^ \t\n\r\f\x0B\p{L}\p{N}]+[\r\n]*|[ \t\n\r\f\x0B]+"


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(NONSPACE), F.lit(0))


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(NONSPACE)).cast("bigint")


def strip(text: Column) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.regexp_replace(text, r"^[ \t\n\r\f\x0B]+|[ \t\n\r\f\x0B]+$", "")


def pretokens(text: Column, pattern: str = PRETOKEN) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def n_pretokens(text: Column, pattern: str = PRETOKEN) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("bigint")


def strip_prefix(text: Column, prefix: Column) -> Column:
    """Remove as many leading characters as the stored prefix has."""
    return F.substr(text, F.length(F.coalesce(prefix, F.lit(""))) + 1)


# Accented Latin letters and their plain forms, for slugs.
ACCENTED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ"
PLAIN = "aaaaaaceeeeiiiinooooouuuuyy"


def slugify(value: Column, sep: str = "-") -> Column:
    """Lower-case ASCII words joined by ``sep``."""
    ascii_text = F.translate(F.lower(value), ACCENTED, PLAIN)
    dashed = F.regexp_replace(ascii_text, "[^a-z0-9]+", sep)
    return F.regexp_replace(dashed, f"^{sep}+|{sep}+$", "")


def camel_to_words(value: Column) -> Column:
    """Put a blank before each inner capital: ``OpenData`` -> ``Open Data``."""
    return F.regexp_replace(value, "(?<!^)(?=[A-Z])", " ")


# Name parts written in capitals.
ALL_CAPS = ("hq", "insee", "hal", "hplt2")


def pascal_case(value: Column, all_caps: tuple[str, ...] = ALL_CAPS) -> Column:
    """Capitalize ``_``/``-`` separated parts and glue them; listed parts go upper-case."""
    parts = F.filter(F.split(value, "[_-]+"), lambda p: p != "")
    return F.array_join(
        F.transform(
            parts,
            lambda p: F.when(F.lower(p).isin(*all_caps), F.upper(p)).otherwise(
                F.concat(F.upper(F.substr(p, F.lit(1), F.lit(1))), F.lower(F.substr(p, F.lit(2))))
            ),
        ),
        "",
    )


def language_pair(doc_id: Column, collection: str = "europarl") -> Column:
    """``europarl_fr-en_v8`` -> ``en-fr``: English first; ``unknown`` without a match."""
    found = F.regexp_extract(doc_id, rf"{collection}_(.*?)_v", 1)
    parts = F.split(found, "-")
    swap = (F.size(parts) == 2) & (F.get(parts, F.lit(1)) == "en")
    return (
        F.when(~doc_id.rlike(rf"{collection}_(.*?)_v"), F.lit("unknown"))
        .when(swap, F.concat(F.lit("en-"), F.get(parts, F.lit(0))))
        .otherwise(found)
    )


def remove_patterns(text: Column, patterns: list[str]) -> Column:
    """Delete every match. Anchor line patterns with ``(?md)^``: unanchored ones retry at each character."""
    for pattern in patterns:
        text = F.regexp_replace(text, pattern, "")
    return text


# Archive mention lines, and the licence tail of public-domain books.
BOOK_NOISE = [
    r"(?md)^[^\n]*http://gallica\.bnf\.fr[^\n]*\n",
    r"(?s)\n\n            \*\*\* END OF THE PROJECT GUTENBERG EBOOK.*",
]

THINK_CLOSED = r"(?s)<think>(.*?)</think>"
THINK_OPEN = r"(?sd)<think>(.*?)(?:</think>|$)"


def split_thinking(text: Column) -> Column:
    """``struct(thoughts, answer)``; without a closed tag the thoughts are empty."""
    tagged = text.rlike(THINK_CLOSED)
    return F.struct(
        F.when(tagged, F.regexp_extract(text, THINK_CLOSED, 1)).otherwise("").alias("thoughts"),
        F.when(tagged, strip(F.regexp_replace(text, THINK_CLOSED, ""))).otherwise(text).alias("answer"),
    )


def extract_thinking(text: Column) -> Column:
    """``struct(cleaned, thinking)``: also takes a block that was never closed."""
    blank = "<think>\n\n</think>"
    return F.struct(
        strip(F.regexp_replace(text, THINK_OPEN, blank)).alias("cleaned"),
        strip(F.regexp_extract(text, THINK_OPEN, 1)).alias("thinking"),
    )


def splice(text: Column, tag: str, replacement: Column) -> Column:
    """Put ``replacement`` between every pair of ``<tag>`` marks, taken literally."""
    hole = f"\u0000{tag}\u0000"
    holed = F.regexp_replace(text, f"(?s)<{tag}>.*?</{tag}>", hole)
    return strip(F.replace(holed, F.lit(hole), F.concat(F.lit(f"<{tag}>"), replacement, F.lit(f"</{tag}>"))))


def chunks_of_min_size(text: Column, min_size: int = 200, sep: str = "\n\n") -> Column:
    """Glue neighbouring parts until a chunk has ``min_size`` characters; the rest is the last chunk."""
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"))

    def step(state: Column, part: Column) -> Column:
        grown = F.when(state["open"] == "", part).otherwise(F.concat(state["open"], F.lit(sep), part))
        full = F.length(grown) >= min_size
        return F.struct(
            F.when(full, F.array_append(state["done"], grown)).otherwise(state["done"]).alias("done"),
            F.when(full, F.lit("")).otherwise(grown).alias("open"),
        )

    def finish(state: Column) -> Column:
        return F.when(state["open"] == "", state["done"]).otherwise(
            F.array_append(state["done"], state["open"])
        )

    return F.aggregate(F.split(text, sep), start, step, finish)


def size_bounded_chunks(
    text: Column, low: int = 1000, high: int = 2000, seps: tuple[str, ...] = ("\n", ". ", ", ", " ")
) -> Column:
    """Cut a whole text into pieces of ``low``..``high`` characters.

    A piece ends at the last occurrence of the first separator that occurs in the
    window; failing all, at ``high``. The final piece may be short. Concatenating
    the pieces gives the text back.
    """
    cuts = []
    for sep in seps:
        body = sep.replace(".", r"\.")
        cuts.append(rf".{{{low - len(sep)},{high - len(sep)}}}{body}")
    pattern = rf"(?s).{{1,{high - 1}}}\z|" + "|".join(cuts) + rf"|.{{1,{high}}}"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def drop_noisy_chunks(
    text: Column,
    max_tokens_per_char: float = 0.38,
    low: int = 1000,
    high: int = 2000,
    seps: tuple[str, ...] = ("\n", ". ", ", ", " "),
    replace_span: str = "\n\n[...]\n\n",
    token_pattern: str = PRETOKEN,
    remove_digits: bool = False,
) -> Column:
    """Replace pieces with too many tokens per character; NULL when no piece survives.

    A run of neighbouring noisy pieces leaves one mark. With ``remove_digits``
    digits do not count, on either side of the ratio.
    """

    def noisy(piece: Column) -> Column:
        seen = F.regexp_replace(piece, "[0-9]", "") if remove_digits else piece
        return (
            F.regexp_count(seen, F.lit(token_pattern)) / F.greatest(F.length(seen), F.lit(1))
            > max_tokens_per_char
        )

    marked = F.transform(
        size_bounded_chunks(text, low, high, seps),
        lambda c: F.struct(c.alias("piece"), noisy(c).alias("bad")),
    )
    start = F.struct(
        F.array().cast("array<string>").alias("out"), F.lit(False).alias("after_bad"), F.lit(False).alias("kept")
    )

    def step(state: Column, c: Column) -> Column:
        nothing = F.array().cast("array<string>")
        added = F.when(~c["bad"], F.array(c["piece"])).when(
            ~state["after_bad"], F.array(F.lit(replace_span))
        ).otherwise(nothing)
        return F.struct(
            F.concat(state["out"], added).alias("out"),
            c["bad"].alias("after_bad"),
            (state["kept"] | ~c["bad"]).alias("kept"),
        )

    return F.aggregate(marked, start, step, lambda s: F.when(s["kept"], F.array_join(s["out"], "")))


def title_missing_from_head(text: Column, title: Column, head: int = 200) -> Column:
    """True when the title is not among the first characters, ignoring case and spacing."""
    start = F.lower(squeeze(F.substring(text, 1, head)))
    return ~F.contains(start, F.lower(title))


def drop_cjk_lines(text: Column) -> Column:
    """Remove lines with more CJK ideographs than Latin letters."""
    def keep(line: Column) -> Column:
        cjk = F.regexp_count(line, F.lit(r"[\x{4e00}-\x{9fff}]"))
        return ~((cjk > 0) & (cjk > F.regexp_count(line, F.lit("[A-Za-z]"))))

    return F.array_join(F.filter(F.split(text, "\n"), keep), "\n")


def cut_long_text(text: Column, max_length: int = 15_000) -> Column:
    """Cut after the last period among the first ``max_length`` characters."""
    head = F.substring(text, 1, max_length)
    from_end = F.instr(F.reverse(head), ".")
    kept = F.when(from_end == 0, head).otherwise(F.substr(head, F.lit(1), F.length(head) - from_end + 1))
    return F.when(F.length(text) > max_length, kept).otherwise(text)


# Fixed values: (pattern, replacement) steps of the classifier's text normalization.
CLASSIFIER_STEPS = [
    ("'", " ' "),
    ('"', ""),
    (r"\.", " . "),
    (r"<br\s*/?>", " "),
    (",", " , "),
    (r"\(", " ( "),
    (r"\)", " ) "),
    ("!", " ! "),
    (r"\?", " ? "),
    (";", " "),
    (":", " "),
]


def normalize_for_classifier(text: Column) -> Column:
    out = F.lower(text)
    for pattern, replacement in CLASSIFIER_STEPS:
        out = F.regexp_replace(out, pattern, replacement)
    return squeeze(out)


def first_json_object(text: Column) -> Column:
    """The first flat ``{...}`` in free text; NULL without one."""
    return F.nullif(F.regexp_extract(text, r"\{[^{}]*\}", 0), F.lit(""))


def json_fields(text: Column, schema: str) -> Column:
    """Typed fields of the first flat JSON object; all NULL where it does not parse."""
    return F.from_json(first_json_object(text), schema, {"mode": "PERMISSIVE"})


def fenced_json(text: Column) -> Column:
    """A JSON object from a Markdown fence, else the first flat object."""
    fenced = F.regexp_extract(text, r"(?s)```(?:json)?\s*(\{.*?\})\s*```", 1)
    return F.coalesce(F.nullif(fenced, F.lit("")), first_json_object(text))


def extract_between(text: Column, start: str = "Web page:\n\n", end: str = "\n\n---") -> Column:
    """The passage between two marks; NULL if either is missing."""
    return F.nullif(F.regexp_extract(text, rf"(?s)\Q{start}\E(.*?)\Q{end}\E", 1), F.lit(""))


def fill_prompt(template: Column | str, text: Column, hole: str = "<text>", max_chars: int = 2000) -> Column:
    base = F.lit(template) if isinstance(template, str) else template
    return F.replace(base, F.lit(hole), F.substring(text, 1, max_chars))


def truncate_marked(text: Column, head: int = 50, tail: int = 50, limit: int = 110) -> Column:
    """Long values shortened to head and tail around the number of hidden characters."""
    shown = F.concat(
        F.substring(text, 1, head),
        F.lit(" ... "),
        (F.length(text) - head - tail).cast("string"),
        F.lit(" ... "),
        F.right(text, F.lit(tail)),
    )
    return F.when(F.length(text) > limit, shown).otherwise(text)


def escape_cell(cell: Column) -> Column:
    flat = F.translate(F.coalesce(cell.cast("string"), F.lit("")), "\n\r", "  ")
    return strip(F.replace(flat, F.lit("|"), F.lit("\\|")))


def table_to_markdown(cells: Column) -> Column:
    """2-D cells to a Markdown table; rows are padded or cut to the header width."""
    def line(row: Column) -> Column:
        return F.concat(F.lit("| "), F.array_join(row, " | "), F.lit(" |"))

    def render(c: Column) -> Column:
        width = F.size(c[0])

        def fitted(row: Column) -> Column:
            missing = F.array_repeat(F.lit(""), F.greatest(width - F.size(row), F.lit(0)))
            return F.slice(F.concat(F.transform(row, escape_cell), missing), F.lit(1), width)

        body = F.transform(
            F.slice(c, F.lit(2), F.greatest(F.size(c) - 1, F.lit(0))), lambda row: line(fitted(row))
        )
        rule = line(F.array_repeat(F.lit("---"), width))
        return F.array_join(F.concat(F.array(line(F.transform(c[0], escape_cell)), rule), body), "\n")

    filled = (F.size(cells) > 0) & (F.size(F.get(cells, F.lit(0))) > 0)
    return F.when(filled, let(cells, render)).otherwise("")


def sentences(text: Column) -> Column:
    """Split after ``.``, ``!`` or ``?`` followed by white space."""
    return F.split(text, r"(?<=[.!?])\s+")


def segment_lengths(tokens: Column, delimiter: str) -> Column:
    """Lengths of the runs that start at each delimiter (cut *before* the delimiter)."""
    def cut(t: Column) -> Column:
        at = F.filter(
            F.sequence(F.lit(0), F.size(t) - 1), lambda i: (i == 0) | (F.get(t, i) == delimiter)
        )
        return let(
            F.concat(at, F.array(F.size(t))),
            lambda edges: F.zip_with(
                F.slice(edges, F.lit(2), F.size(edges) - 1),
                F.slice(edges, F.lit(1), F.size(edges) - 1),
                lambda end, start: (end - start).cast("int"),
            ),
        )

    return F.when(F.size(tokens) > 0, let(tokens, cut)).otherwise(F.array().cast("array<int>"))


def geometric_break(*keys: Column | str, p: float = 1 / 3, seed: int | str = 42) -> Column:
    """True where a chunk ends after this row; chunk lengths are geometric with mean 1/p."""
    return uniform(*keys, seed=seed) < p
