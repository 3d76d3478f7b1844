"""Labels and buckets computed from one row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper bounds (exclusive) and names of duplication-cluster buckets above four copies.
CLUSTER_BUCKETS = [(100, "cluster_size-5-100"), (1000, "cluster_size-100-1000")]
CLUSTER_REST = "cluster_size-1000+"

# Token-length buckets.
LENGTH_BUCKETS = [(4096, "0-4k"), (16384, "4k-16k"), (65536, "16k-64k")]
LENGTH_REST = "64k+"

# Phrases that tell the difficulty of a writing prompt.
PROMPT_LEVELS = [
    ("very small vocabulary and extremely simple sentences", "easy"),
    ("using high quality French language such as in sentences on Wikipedia", "medium"),
    ("using very terse and abstruse language that only an erudite scholar will understand", "hard"),
]

# Language families and web sources of the token reports.
SAME_LANGUAGE = ["code", "math", "fr", "en", "aligned", "multi", "cot"]
EURO_ARAB = ["ar", "nl", "de", "pt", "es", "it"]
REGIONAL = ["ca", "eu", "regional"]
WEB_NAMES = ["fineweb", "dclm", "culturax", "hplt2"]


def _first_match(tests: list[tuple[Column, Column]], rest: Column) -> Column:
    out = None
    for condition, value in tests:
        out = F.when(condition, value) if out is None else out.when(condition, value)
    return out.otherwise(rest)


def cluster_bucket(size: Column) -> Column:
    exact = F.concat(F.lit("cluster_size-"), size.cast("string"))
    tests = [(size.between(1, 4), exact)] + [(size < b, F.lit(n)) for b, n in CLUSTER_BUCKETS]
    return _first_match(tests, F.lit(CLUSTER_REST))


def length_bucket(length: Column) -> Column:
    return _first_match([(length < b, F.lit(n)) for b, n in LENGTH_BUCKETS], F.lit(LENGTH_REST))


def prompt_level(instruction: Column, levels: list[tuple[str, str]] | None = None) -> Column:
    tests = [(F.contains(instruction, F.lit(p)), F.lit(n)) for p, n in levels or PROMPT_LEVELS]
    return _first_match(tests, F.lit("unknown"))


def fixed_point(value: Column, digits: int) -> Column:
    """Text with ``digits`` decimals, rounded on the exact binary value as C's printf does."""
    return F.translate(F.format_number(value, digits), ",", "")


def rounded_quality(score: Column, step: float = 0.05) -> Column:
    """The score rounded half-even to a multiple of ``step``, as text with two decimals."""
    return fixed_point(F.bround(F.coalesce(score, F.lit(0.0)) / step) * step, 2)


def expected_score(label_probs: Column) -> Column:
    """Expectation of ``__label__k -> p`` maps; NULL for a NULL map."""
    return F.aggregate(
        F.map_entries(label_probs),
        F.lit(0.0),
        lambda total, e: total + F.element_at(F.split(e["key"], "__label__"), -1).cast("int") * e["value"],
    )


# Language of sets by a part of their name, and parts of which one must also be there.
LANGUAGE_BY_NAME = [
    ("nemotron-post", ("think", "stem"), "cot"),
    ("numina", (), "math"),
    ("open-thoughts", (), "cot"),
    ("stack-math-qa", (), "math"),
    ("open-r1", (), "cot"),
    ("open-code-reasoning", (), "cot"),
]


def dataset_language(name: Column, language: Column) -> Column:
    """Override the language of reasoning and mathematics sets by their name."""
    def test(part: str, also: tuple[str, ...]) -> Column:
        found = F.contains(name, F.lit(part))
        return found & name.rlike("|".join(also)) if also else found

    return _first_match([(test(part, also), F.lit(value)) for part, also, value in LANGUAGE_BY_NAME], language)


def language_family(language: Column) -> Column:
    """Report family of a language; an unknown one is an error."""
    return _first_match(
        [
            (language.isin(*SAME_LANGUAGE), language),
            (language.isin(*EURO_ARAB), F.lit("euro/arab")),
            (language.isin(*REGIONAL), F.lit("regional")),
        ],
        F.raise_error(F.concat(F.lit("Unknown language: "), language)).cast("string"),
    )


def web_label(name: Column) -> Column:
    is_web = F.lit(False)
    for part in WEB_NAMES:
        is_web = is_web | F.contains(name, F.lit(part))
    return F.when(is_web, "web").otherwise("no_web")


# Thresholds and units of token counts in reports.
TOKEN_UNITS = [(1e12, 2, " T"), (1e9, 1, " B"), (1e6, 1, " M"), (1e3, 1, " K")]


def format_tokens(tokens: Column) -> Column:
    amount = tokens.cast("double")
    tests = [
        (amount >= unit, F.concat(fixed_point(amount / unit, digits), F.lit(sign))) for unit, digits, sign in TOKEN_UNITS
    ]
    tests.append((amount > 0, fixed_point(amount, 1)))
    return _first_match(tests, F.lit(""))


# Replacements, in this order, that turn a task id into a display name.
TASK_NAMES = [
    ("_all_", "_"), ("mmlu", "MMLU"), ("arc", "ARC"), ("hellaswag", "HellaSwag"),
    ("winogrande", "Winogrande"), ("gsm8k", "GSM8K"), ("boolq", "BoolQ"),
    ("commonsenseqa", "CommonsenseQA"), ("belebele", "Belebele"), ("siqa", "SIQA"),
    ("openbookqa", "OpenBookQA"), ("piqa", "PIQA"), ("triviaqa", "TriviaQA"),
    ("mintaka", "Mintaka"), ("fquadv2", "FQuADv2"), ("xcodah", "XCODAH"), ("xcsqa", "XCSQA"),
    ("xnli", "XNLI"), ("mlmm", "MLMM"), ("flores200", "FLORES"), ("cwe", "CWE"), ("fwe", "FWE"),
    ("niah_", "NIAH_"), ("qa_", "QA_"), ("vt", "VT"), ("_Latn", ""), ("_cf", ""),
    (":_average", ""), ("_", " "), (":", " "),
]


def format_task(task: Column) -> Column:
    """``suite|task_cf:subset|shots`` -> a readable task name."""
    parts = F.split(task, r"\|")
    name = F.when(F.size(parts).isin(2, 3), F.element_at(parts, 2)).otherwise(task)
    name = F.regexp_replace(name, "_cf$", "")
    for old, new in TASK_NAMES:
        name = F.replace(name, F.lit(old), F.lit(new))
    return F.trim(name)


def name_parts(name: Column) -> Column:
    """``dataset[_subset]_language``; more than three parts is an error."""
    parts = F.split(name, "_")
    checked = F.when(F.size(parts) <= 3, parts).otherwise(
        F.raise_error(F.concat(F.lit("too many parts in name: "), name)).cast("array<string>")
    )
    return F.struct(
        checked[0].alias("dataset"),
        F.when(F.size(checked) == 3, checked[1]).alias("subset"),
        F.element_at(checked, -1).alias("language"),
    )


# Fixed value: shape of names that carry a cluster or score group.
CLUSTER_NAME = r"(fineweb2_.*_(cluster|edu))_(.*)"


def cluster_name_parts(name: Column) -> Column:
    """``(dataset, group_type, group_name)``; the groups are NULL for other names."""
    hit = name.rlike(CLUSTER_NAME)
    return F.struct(
        F.when(hit, F.regexp_extract(name, CLUSTER_NAME, 1)).otherwise(name).alias("dataset"),
        F.when(hit, F.regexp_extract(name, CLUSTER_NAME, 2)).alias("group_type"),
        F.when(hit, F.regexp_extract(name, CLUSTER_NAME, 3)).alias("group_name"),
    )


def step_number(name: Column) -> Column:
    """``struct(is_global, step)`` from ``totalstep=..`` or ``step=..`` in a checkpoint name."""
    total = F.regexp_extract(name, r"totalstep[=_-]?(\d+)", 1)
    local = F.regexp_extract(name, r"step[=_-]?(\d+)", 1)
    return F.struct(
        (total != "").alias("is_global"),
        F.nullif(F.when(total != "", total).otherwise(local), F.lit("")).cast("bigint").alias("step"),
    )
