"""Question-answering rows: context assembly, unanswerable rows, scoring and formatting.

A row has ``id``, ``question``, ``answer``, ``context`` (parallel ``title`` and
``sentences`` arrays) and ``supporting_facts`` (``title``). The passages of a
question are one record, so shuffles and removals inside a row are array
expressions ordered by a hash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textquarry.functions.answers import (
    citation_scores,
    extract_answer,
    extract_citations,
    match_type,
    normalize_answer,
    numbers,
    numeric_match,
    parse_number,
)
from textquarry.functions.hashing import let, pick, uniform
from textquarry.functions.text import strip
from textquarry.operators.sampling import smallest_hashes


def passages(context: Column) -> Column:
    """Parallel arrays to ``array<struct<title, text>>``."""
    return F.zip_with(
        context["title"],
        context["sentences"],
        lambda title, s: F.struct(title.alias("title"), F.trim(F.array_join(s, " ")).alias("text")),
    )


# Fixed value: the refusal of a question the context does not answer.
REFUSAL = "The retrieved documents do not allow me to answer your question. Could you rephrase it or add relevant documents?"


def make_unanswerable(df: DataFrame, min_passages: int = 1, drop_table: bool = False) -> DataFrame:
    """Take the supporting passages away, blank the answer and mark the row.

    Rows with fewer than ``min_passages`` passages left are dropped. With
    ``drop_table`` the table also goes when the answer came from it.
    """
    relevant = F.col("supporting_facts.title")
    zipped = F.arrays_zip(F.col("context.title").alias("title"), F.col("context.sentences").alias("sentences"))

    def keep(p: Column) -> Column:
        out = ~F.array_contains(relevant, p["title"])
        if drop_table:
            out = out & ~((F.col("answer_from") == "table") & (p["title"] == "Table"))
        return out

    left = df.withColumn("_kept", F.filter(zipped, keep)).where(F.size("_kept") >= min_passages)
    return left.withColumns(
        {
            "id": F.concat("id", F.lit("_unanswerable")),
            "answer": F.lit(""),
            "context": F.struct(F.col("_kept.title").alias("title"), F.col("_kept.sentences").alias("sentences")),
            "supporting_facts": F.struct(F.array().cast("array<string>").alias("title")),
            "is_unanswerable": F.lit(True),
            "reasoning_trace": F.lit(REFUSAL),
        }
    ).drop("_kept")


def add_unanswerable(
    df: DataFrame, ratio: float = 0.1, seed: int = 42, min_passages: int = 1, drop_table: bool = False
) -> DataFrame:
    """Add unanswerable copies of a random share of the answerable rows.

    Rows that are already unanswerable count towards the share.
    """
    flagged = df.withColumn("is_unanswerable", F.coalesce("is_unanswerable", F.lit(False)))
    totals = flagged.agg(F.count("*").alias("n"), F.count_if("is_unanswerable").alias("u")).first()
    wanted = min(max(0, int(totals["n"] * ratio) - totals["u"]), totals["n"] - totals["u"])
    if wanted == 0:
        return flagged
    answerable = flagged.where("NOT is_unanswerable")
    chosen = smallest_hashes(answerable, wanted, "id", seed)[0]
    return flagged.unionByName(make_unanswerable(chosen, min_passages, drop_table))


def assemble_context(
    df: DataFrame, max_remove: float = 0.7, min_chunks: int = 2, protected: tuple[str, ...] = (), shuffle: bool = True,
    seed: int = 42,
) -> DataFrame:
    """Drop a random part of the background passages, shuffle and format the rest.

    At most ``max_remove`` of the removable background goes, never so much that
    fewer than ``min_chunks`` passages remain. Adds the text and its counts.
    """
    relevant = F.col("supporting_facts.title")
    keep_always = F.array(*[F.lit(p) for p in protected]).cast("array<string>")

    def tagged(p: Column, i: Column) -> Column:
        is_relevant = F.array_contains(relevant, p["title"])
        removable = ~is_relevant & ~F.array_contains(keep_always, p["title"])
        return F.struct(
            removable.alias("removable"),
            uniform(F.col("id"), i, seed=f"{seed}-drop").alias("u"),
            i.alias("i"),
            is_relevant.alias("relevant"),
            uniform(F.col("id"), i, seed=f"{seed}-order").alias("v"),
            p["title"].alias("title"),
            p["text"].alias("text"),
        )

    df = df.withColumn("_p", F.array_sort(F.transform(passages(F.col("context")), tagged)))
    removable = F.size(F.filter("_p", lambda p: p["removable"]))
    background = F.size(F.filter("_p", lambda p: ~p["relevant"]))
    ratio = uniform("id", seed=f"{seed}-ratio") * max_remove
    cut = F.least(F.floor(removable * ratio).cast("int"), F.greatest(F.size("_p") - min_chunks, F.lit(0)))
    df = df.withColumns({"_cut": cut, "_removable": removable, "chunks_background_initial": background})
    # Sorted, the removable ones come last in random order: the tail of the list is what goes.
    df = df.withColumn("_kept", F.slice("_p", F.lit(1), F.size("_p") - F.col("_cut")))
    place = (lambda p: F.struct(p["v"], p["i"], p["title"], p["text"])) if shuffle else (
        lambda p: F.struct(F.when(p["relevant"], 0).when(p["removable"], 2).otherwise(1), p["i"], p["title"], p["text"])
    )
    ordered = F.array_sort(F.transform("_kept", place))
    text = F.array_join(F.transform(ordered, lambda p: F.concat(F.lit("["), p["title"], F.lit("]\n"), p["text"])), "\n\n")
    return df.withColumns(
        {
            "context_text": text,
            "chunks_relevant": F.size("_p") - F.col("chunks_background_initial"),
            "chunks_background_removed": F.col("_cut"),
            "chunks_background_final": F.col("chunks_background_initial") - F.col("_cut"),
            "chunks_total": F.size("_kept"),
        }
    ).drop("_p", "_kept", "_cut", "_removable")


def score_answers(df: DataFrame, reasoning: str = "reasoning_trace", expected: str = "answer") -> DataFrame:
    """Extract the final answer and compare it with the expected one."""
    extracted = F.when(~F.coalesce("is_unanswerable", F.lit(False)), extract_answer(F.col(reasoning)))
    out = df.withColumn("eval_extracted_answer", extracted)
    kind = F.when(F.coalesce("is_unanswerable", F.lit(False)), "unanswerable").otherwise(
        match_type(F.col(expected), F.col("eval_extracted_answer"))
    )
    out = out.withColumn("eval_answer_match_type", kind)
    return out.withColumn("eval_answer_correct", F.col("eval_answer_match_type") != "none")


def accuracy(df: DataFrame, by: list[str]) -> DataFrame:
    return df.groupBy(*by).agg(
        F.count("*").alias("total"),
        F.count_if("eval_answer_correct").alias("correct"),
        (F.count_if("eval_answer_correct") / F.count("*")).alias("accuracy"),
    )


def table_match_type(
    answer_type: Column, answer: Column, answer_raw: Column, scale: Column, extracted: Column
) -> Column:
    """Score one table answer by its type: span, multi-span, arithmetic or count."""
    listed = F.startswith(F.ltrim(answer_raw), F.lit("["))
    raw_items = F.when(listed, F.from_json(answer_raw, "array<string>"))
    spans = F.coalesce(raw_items, F.filter(F.transform(F.split(answer, ","), strip), lambda s: s != ""))

    # Every expected span must occur in the extracted answer.
    def all_found(seen: Column) -> Column:
        return F.forall(
            spans, lambda s: let(normalize_answer(s), lambda n: (n != "") & F.contains(seen, n))
        )

    multi = F.when(let(normalize_answer(extracted), all_found), "multi_span_all").otherwise("none")
    candidates = F.filter(
        F.transform(F.coalesce(raw_items, F.array(F.coalesce(answer_raw, answer))), parse_number), lambda v: v.isNotNull()
    )
    observed = numbers(extracted)
    seen = F.when(F.size(observed) > 0, observed).otherwise(
        F.filter(F.array(parse_number(extracted)), lambda v: v.isNotNull())
    )
    numeric = F.when(F.size(candidates) == 0, match_type(answer, extracted)).when(
        numeric_match(candidates, seen, scale), "numeric_tol_1pct"
    ).otherwise("none")
    return (
        F.when(extracted.isNull(), "none")
        .when(answer_type == "multi-span", multi)
        .when(answer_type.isin("arithmetic", "count"), numeric)
        .otherwise(match_type(answer, extracted))
    )


def score_table_answers(df: DataFrame, extracted: str = "eval_extracted_answer") -> DataFrame:
    kind = table_match_type(F.col("answer_type"), F.col("answer"), F.col("answer_raw"), F.col("scale"), F.col(extracted))
    kind = F.when(F.coalesce("is_unanswerable", F.lit(False)), "unanswerable").otherwise(kind)
    return df.withColumn("eval_answer_match_type", kind).withColumn(
        "eval_answer_correct", F.col("eval_answer_match_type") != "none"
    )


def score_citations(df: DataFrame, reasoning: str = "reasoning_trace", expected: str = "supporting_facts_titles") -> DataFrame:
    """Cited titles against the supporting ones, row by row."""
    cited = df.withColumn("eval_cited_titles", extract_citations(F.col(reasoning)))
    scored = cited.withColumn("_s", citation_scores(F.col("eval_cited_titles"), F.col(expected)))
    return scored.select(
        *cited.columns,
        F.col("_s.precision").alias("eval_chunk_precision"),
        F.col("_s.recall").alias("eval_chunk_recall"),
        F.col("_s.f1").alias("eval_chunk_f1"),
        F.col("_s.extra").alias("extra_citations"),
        F.col("_s.missed").alias("missed_citations"),
    )


def citation_report(df: DataFrame, expected: str = "supporting_facts_titles") -> DataFrame:
    """Corpus-level citation quality. The F1 of the means and the mean of the row F1 are both given."""
    p, r = F.avg("eval_chunk_precision"), F.avg("eval_chunk_recall")
    report = df.where(F.size(expected) > 0).agg(
        F.count("*").alias("evaluated"),
        F.count_if(F.size("eval_cited_titles") > 0).alias("with_citations"),
        p.alias("mean_precision"),
        r.alias("mean_recall"),
        F.avg("eval_chunk_f1").alias("mean_f1"),
        F.count_if((F.col("eval_chunk_precision") == 1) & (F.col("eval_chunk_recall") == 1)).alias("perfect"),
        F.sum("extra_citations").alias("extra"),
        F.sum("missed_citations").alias("missed"),
    )
    both = F.col("mean_precision") + F.col("mean_recall")
    return report.withColumn(
        "f1_of_means", F.when(both > 0, 2 * F.col("mean_precision") * F.col("mean_recall") / both).otherwise(0.0)
    )


# Separator of context blocks, and the title line of a block.
CONTEXT_SEPARATOR = "\n----------\n\n"
_BLOCK = r"\n?\[([^\]]+)\]\n"


def reformat_context(raw: Column) -> Column:
    """``[Title]`` blocks re-joined with the separator line; titles stay for citation."""
    def rebuild(clean: Column) -> Column:
        def blocks(both: Column) -> Column:
            head = strip(F.get(both["bodies"], F.lit(0)))
            chunks = F.transform(
                both["titles"],
                lambda title, i: let(
                    strip(F.coalesce(F.get(both["bodies"], i + 1), F.lit(""))),
                    lambda body: F.concat(
                        F.lit("["), title, F.lit("]"), F.when(body != "", F.concat(F.lit("\n"), body)).otherwise("")
                    ),
                ),
            )
            first = F.when(head != "", F.array(head)).otherwise(F.array().cast("array<string>"))
            return F.array_join(F.concat(first, chunks), CONTEXT_SEPARATOR)

        return let(
            F.struct(
                F.regexp_extract_all(clean, F.lit(_BLOCK), F.lit(1)).alias("titles"), F.split(clean, _BLOCK).alias("bodies")
            ),
            blocks,
        )

    joined = let(F.replace(raw, F.lit("-" * 10), F.lit("\n")), rebuild)
    return F.when(joined == "", strip(raw)).otherwise(joined)


@dataclass(frozen=True)
class CitationStyle:
    name: str
    begin_quote: str
    end_quote: str
    cite: str


# Citation mark-up styles; {title} stands for the source.
CITATION_STYLES = [
    CitationStyle("default", "##begin_quote##", "##end_quote##", '##Cite "{title}"##'),
    CitationStyle("xml", "<quote>", "</quote>", '<cite>"{title}"</cite>'),
    CitationStyle("bracket", "[QUOTE]", "[/QUOTE]", '[Source: "{title}"]'),
    CitationStyle("double_angle", "<<quote>>", "<</quote>>", '<<cite: "{title}">>'),
]
REFERENCES_HEADER = {"en": "**References**", "fr": "**Références**"}
END_OF_COMPLETION_SHARE = 0.30
# The citation mark, and its looser forms in double and single quotes.
_CITE = r'##Cite "([^"]*)"##'
_LOOSE_CITES = [r'##Cite\s+"([^"]*?)"\s*##', r"##Cite\s+'([^']*?)'\s*##"]


def normalize_citations(text: Column) -> Column:
    """All citation marks in double quotes and without extra blanks."""
    for loose in _LOOSE_CITES:
        text = F.regexp_replace(text, loose, '##Cite "$1"##')
    return text


def _styled(template: str, title: str) -> str:
    return template.replace("$", r"\$").replace("{title}", title)


def restyle_citations(completion: Column, style: CitationStyle, at_end: bool, language: str = "en") -> Column:
    """Quotes and citations in the given style, inline or collected at the end."""
    text = F.replace(completion, F.lit("##begin_quote##"), F.lit(style.begin_quote))
    text = F.replace(text, F.lit("##end_quote##"), F.lit(style.end_quote))
    if not at_end:
        return F.regexp_replace(text, _CITE, _styled(style.cite, "$1"))
    titles = F.array_distinct(F.regexp_extract_all(text, F.lit(_CITE), F.lit(1)))
    bare = F.regexp_replace(F.regexp_replace(text, r"\s*" + _CITE, ""), r"\s+\z", "")
    before, after = style.cite.split("{title}")
    listed = F.array_join(F.transform(titles, lambda x: F.concat(F.lit("- " + before), x, F.lit(after))), "\n")
    header = REFERENCES_HEADER.get(language, REFERENCES_HEADER["en"])
    return F.when(F.size(titles) > 0, F.concat(bare, F.lit(f"\n\n{header}\n"), listed)).otherwise(bare)


@dataclass(frozen=True)
class SftTexts:
    """The wording of a training set, one per language; the caller supplies it."""

    prompt: str
    system: str
    inline_instruction: str
    end_instruction: str
    refusals: tuple[str, ...] = (REFUSAL,)
    language: str = "en"


PLAIN_TEXTS = SftTexts(
    prompt="Answer from the context only. {citation_instruction}\n\nContext: `{context}`\n\nQuestion: '{question}'",
    system="Answer from the context only. {citation_instruction}\n\nContext: `{context}`",
    inline_instruction="Wrap excerpts with `{begin}` and `{end}` and attribute them with `{cite}`.",
    end_instruction="Wrap excerpts with `{begin}` and `{end}` and list sources at the end as `{cite}`.",
)


def to_sft(df: DataFrame, texts: SftTexts = PLAIN_TEXTS, chat: bool = False, seed: int = 42) -> DataFrame:
    """Training rows: a prompt and a completion, or a three-turn chat.

    Citation style, inline or collected citations, and the wording of a refusal
    are drawn by the row id. Other columns are kept.
    """
    style_no = F.floor(uniform("id", seed=f"{seed}-style") * len(CITATION_STYLES)).cast("int")
    at_end = uniform("id", seed=f"{seed}-end") < END_OF_COMPLETION_SHARE
    trace = normalize_citations(F.col("reasoning_trace"))

    def choose(fn) -> Column:
        out = None
        for i, style in enumerate(CITATION_STYLES):
            for end in (False, True):
                test, value = (style_no == i) & (at_end if end else ~at_end), fn(style, end)
                out = F.when(test, value) if out is None else out.when(test, value)
        return out

    def instruction(style: CitationStyle, end: bool) -> Column:
        text = texts.end_instruction if end else texts.inline_instruction
        filled = text.replace("{begin}", style.begin_quote).replace("{end}", style.end_quote)
        return F.lit(filled.replace("{cite}", style.cite.replace("{title}", "source title")))

    def fill(template: str) -> Column:
        out = F.replace(F.lit(template), F.lit("{citation_instruction}"), F.col("_instruction"))
        out = F.replace(out, F.lit("{question}"), F.col("question"))
        return F.replace(out, F.lit("{context}"), reformat_context(F.col("context_text")))

    completion = F.when(
        F.coalesce("is_unanswerable", F.lit(False)), pick(list(texts.refusals), "id", seed=f"{seed}-refusal")
    ).otherwise(choose(lambda style, end: restyle_citations(trace, style, end, texts.language)))
    rows = df.withColumns(
        {
            "_instruction": choose(instruction),
            "_completion": completion,
            "citation_style": choose(lambda style, _: F.lit(style.name)),
            "end_of_completion_citations": at_end,
        }
    )
    kept = [c for c in df.columns if c not in ("question", "context", "context_text", "reasoning_trace", "answer")]
    extra = [*kept, "citation_style", "end_of_completion_citations"]
    if not chat:
        return rows.select(fill(texts.prompt).alias("prompt"), F.col("_completion").alias("completion"), *extra)

    def message(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    messages = F.array(
        message("system", fill(texts.system)), message("user", F.col("question")), message("assistant", F.col("_completion"))
    )
    return rows.select(messages.alias("messages"), *extra)
