"""Row-level text operators over documents, conversations and benchmark items."""

from __future__ import annotations

from pyspark.sql import functions as F

from textquarry.functions import labels as L
from textquarry.functions import pii
from textquarry.functions import text as X
from textquarry.operators.projections import add_prefix, title_field
from textquarry.plans import sqlbits as S
from textquarry.plans.registry import query


def sql_mask_pii(col: str, ips: bool = True) -> str:
    out = f"regexp_replace({col}, '{pii.EMAIL}', '{pii.EMAIL_MARK}', 'g')"
    return f"regexp_replace({out}, '{pii.IPV4}', '\\1{pii.IP_MARK}\\2', 'g')" if ips else out


def sql_mask_phone(col: str, lang: str) -> str:
    def one(regions):
        return f"regexp_replace({col}, '{pii.phone_pattern(regions)}', '\\1{pii.PHONE_MARK}\\2', 'g')"

    whens = " ".join(f"WHEN '{l}' THEN {one(r)}" for l, r in pii.PHONE_REGIONS.items())
    return f"CASE {lang} {whens} ELSE {one(pii.DEFAULT_REGIONS)} END"


@query(
    "mask_email_and_ip", "T1",
    f"SELECT doc_id, md5({sql_mask_pii('text')}) AS masked, md5({sql_mask_pii('text', False)}) AS ips_kept FROM documents",
)
def mask_email_and_ip(t):
    both = pii.mask_pii(t.documents.withColumn("mail_only", F.col("text")))
    both = pii.mask_pii(both, "mail_only", remove_ips=False)
    return both.select("doc_id", F.md5("text").alias("masked"), F.md5("mail_only").alias("ips_kept"))


@query(
    "mask_phone", "T2",
    f"""SELECT doc_id, md5({sql_mask_phone('text', 'lang')}) AS masked,
               contains({sql_mask_phone('text', 'lang')}, '{pii.PHONE_MARK}') AS changed FROM documents""",
)
def mask_phone(t):
    return pii.mask_phone(t.documents).select(
        "doc_id", F.md5("text").alias("masked"), F.contains("text", F.lit(pii.PHONE_MARK)).alias("changed")
    )


@query("drop_noisy_chunks", "T3")
def drop_noisy_chunks(t):
    cleaned = t.documents.withColumn("cleaned", X.drop_noisy_chunks(F.col("text"), max_tokens_per_char=0.30))
    return cleaned.where("cleaned IS NOT NULL").select("doc_id", F.length("cleaned").alias("n_chars"), F.md5("cleaned").alias("digest"))


@query(
    "metadata_prefix", "T4",
    """WITH m AS (SELECT doc_id, text, source, CASE WHEN contains(source, '1') THEN substr(text, 1, 12) ELSE 'Report ' || doc_id END AS title,
                    CASE WHEN lang = 'en' THEN NULL ELSE lang END AS channel FROM documents),
            p AS (SELECT *, concat_ws(chr(10), 'Channel: ' || channel,
                    CASE WHEN NOT contains(lower(trim(regexp_replace(substr(text, 1, 200), '[ \t\n\r\f\x0B]+', ' ', 'g'))), lower(title)) THEN 'Title: ' || title END,
                    'Fields: ' || source) || chr(10) || chr(10) AS prefix FROM m)
       SELECT doc_id, prefix, md5(prefix || text) AS digest FROM p""",
)
def metadata_prefix(t):
    title = F.when(F.contains("source", F.lit("1")), F.substring("text", 1, 12)).otherwise(F.concat(F.lit("Report "), "doc_id"))
    out = add_prefix(
        t.documents,
        [
            ("Channel", F.when(F.col("lang") != "en", F.col("lang"))),
            ("Title", title_field(F.col("text"), title)),
            ("Fields", F.col("source")),
        ],
    )
    return out.select("doc_id", "prefix", F.md5("text").alias("digest"))


_NOISE = [r"(?m)^[^\n]*on the[^\n]*\n", r"(?s)\n[^\n]*tionally.*"]


@query(
    "remove_patterns", "T5",
    rf"SELECT doc_id, md5(regexp_replace(regexp_replace(text, '{_NOISE[0]}', '', 'g'), '{_NOISE[1]}', '', 'g')) AS digest FROM documents",
)
def remove_patterns(t):
    return t.documents.select("doc_id", F.md5(X.remove_patterns(F.col("text"), _NOISE)).alias("digest"))


@query(
    "remove_book_noise", "T5",
    """SELECT doc_id, md5(text || chr(10) || 'body') AS digest FROM documents""",
)
def remove_book_noise(t):
    noisy = F.concat(
        "text", F.lit("\nSource: http://gallica.bnf.fr/ark:/1\nbody"),
        F.lit("\n\n            *** END OF THE PROJECT GUTENBERG EBOOK X ***\nlicence\nlines"),
    )
    return t.documents.select("doc_id", F.md5(X.remove_patterns(noisy, X.BOOK_NOISE)).alias("digest"))


# Assistant turns get a reasoning block: closed, left open, or none, by turn number.
_TAGGED_SQL = """SELECT conv_id, turn, CASE WHEN role <> 'assistant' THEN text WHEN turn % 4 = 1 THEN '<think>' || substr(text, 1, 40) || '</think> ' || substr(text, 41)
                 WHEN turn % 8 = 3 THEN '<think>' || text ELSE text END AS text FROM conversations"""


def tagged_turns(t):
    text, turn = F.col("text"), F.col("turn")
    closed = F.concat(F.lit("<think>"), F.substring(text, 1, 40), F.lit("</think> "), F.substr(text, F.lit(41)))
    tagged = (
        F.when(F.col("role") != "assistant", text)
        .when(turn % 4 == 1, closed)
        .when(turn % 8 == 3, F.concat(F.lit("<think>"), text))
        .otherwise(text)
    )
    return t.conversations.withColumn("text", tagged)


_STRIP = r"regexp_replace({}, '^[ \t\n\r\f\x0B]+|[ \t\n\r\f\x0B]+$', '', 'g')"


@query(
    "split_thinking", "T6",
    rf"""WITH t AS ({_TAGGED_SQL})
        SELECT conv_id, turn, regexp_extract(text, '(?s)<think>(.*?)</think>', 1) AS thoughts,
               CASE WHEN regexp_matches(text, '(?s)<think>(.*?)</think>')
                    THEN {_STRIP.format("regexp_replace(text, '(?s)<think>(.*?)</think>', '', 'g')")} ELSE text END AS answer FROM t""",
)
def split_thinking(t):
    return tagged_turns(t).select("conv_id", "turn", X.split_thinking(F.col("text")).alias("s")).select("conv_id", "turn", "s.*")


@query(
    "extract_thinking", "T7",
    rf"""WITH t AS ({_TAGGED_SQL})
        SELECT conv_id, turn, {_STRIP.format("regexp_replace(text, '(?s)<think>(.*?)(?:</think>|$)', '<think>' || chr(10) || chr(10) || '</think>', 'g')")} AS cleaned,
               {_STRIP.format("regexp_extract(text, '(?s)<think>(.*?)(?:</think>|$)', 1)")} AS thinking FROM t""",
)
def extract_thinking(t):
    return tagged_turns(t).select("conv_id", "turn", X.extract_thinking(F.col("text")).alias("s")).select("conv_id", "turn", "s.*")


@query(
    "splice_thinking", "T8",
    rf"""WITH t AS ({_TAGGED_SQL})
        SELECT conv_id, turn, CASE WHEN contains(text, '</think>') THEN {_STRIP.format("'<think>$1 ' || turn || '</think>' || split_part(text, '</think>', 2)")}
               ELSE {_STRIP.format("text")} END AS spliced FROM t""",
)
def splice_thinking(t):
    new = F.concat(F.lit("$1 "), F.col("turn").cast("string"))
    return tagged_turns(t).select("conv_id", "turn", X.splice(F.col("text"), "think", new).alias("spliced"))


@query(
    "chunk_min_size", "T9",
    """WITH RECURSIVE p AS (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents),
       r(doc_id, parts, i, buf, done) AS (
         SELECT doc_id, parts, 0, '', NULL::VARCHAR FROM p
         UNION ALL
         SELECT doc_id, parts, i + 1,
                CASE WHEN length(g) >= 400 THEN '' ELSE g END, CASE WHEN length(g) >= 400 THEN g END
         FROM (SELECT *, CASE WHEN buf = '' THEN parts[i + 1] ELSE buf || chr(10) || parts[i + 1] END AS g FROM r WHERE i < len(parts))),
       chunks AS (SELECT doc_id, i, done AS chunk FROM r WHERE done IS NOT NULL
                  UNION ALL SELECT doc_id, i + 1, buf FROM r WHERE i = len(parts) AND buf <> '')
       SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1)::INT AS chunk_id,
              count(*) OVER (PARTITION BY doc_id)::INT AS num_chunks, md5(chunk) AS digest FROM chunks""",
)
def chunk_min_size(t):
    from textquarry.operators.dialogue import chunk_rows

    chunks = chunk_rows(t.documents, "text", min_size=400, sep="\n")
    return chunks.select("doc_id", "chunk_id", "num_chunks", F.md5("chunk").alias("digest"))


@query(
    "concat_fields", "T12",
    "SELECT doc_id, md5(trim(text || chr(10) || source || chr(10) || lang)) AS digest FROM documents",
)
def concat_fields(t):
    return t.documents.select("doc_id", F.md5(X.strip(F.concat_ws("\n", "text", "source", "lang"))).alias("digest"))


@query(
    "drop_cjk_lines", "T16",
    r"""WITH l AS (SELECT doc_id, unnest(string_split(text || chr(10) || '汉字汉字 ab' || chr(10) || '漢 abc', chr(10))) AS line,
                   generate_subscripts(string_split(text || chr(10) || '汉字汉字 ab' || chr(10) || '漢 abc', chr(10)), 1) AS i FROM documents)
        SELECT doc_id, md5(string_agg(line, chr(10) ORDER BY i)) AS digest FROM l
        WHERE NOT (len(regexp_extract_all(line, '[一-鿿]')) > 0 AND len(regexp_extract_all(line, '[一-鿿]')) > len(regexp_extract_all(line, '[A-Za-z]')))
        GROUP BY doc_id""",
)
def drop_cjk_lines(t):
    mixed = F.concat("text", F.lit("\n汉字汉字 ab\n漢 abc"))
    return t.documents.select("doc_id", F.md5(X.drop_cjk_lines(mixed)).alias("digest"))


@query(
    "cut_long_text", "T17",
    """SELECT doc_id, md5(CASE WHEN length(text) > 1500 THEN CASE WHEN contains(substr(text, 1, 1500), '.')
              THEN substr(text, 1, 1501 - strpos(reverse(substr(text, 1, 1500)), '.')) ELSE substr(text, 1, 1500) END
              ELSE text END) AS digest FROM documents""",
)
def cut_long_text(t):
    return t.documents.select("doc_id", F.md5(X.cut_long_text(F.col("text"), 1500)).alias("digest"))


def _sql_classifier(col: str) -> str:
    out = f"lower({col})"
    for pattern, replacement in X.CLASSIFIER_STEPS:
        out = "regexp_replace({}, '{}', '{}', 'g')".format(out, pattern.replace("'", "''"), replacement.replace("'", "''"))
    return S.squeeze(out)


@query(
    "normalize_for_classifier", "T18",
    f"SELECT doc_id, md5({_sql_classifier('text')}) AS digest FROM documents",
)
def normalize_for_classifier(t):
    return t.documents.select("doc_id", F.md5(X.normalize_for_classifier(F.col("text"))).alias("digest"))


@query(
    "json_fields", "T19",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE json_extract(props, '$.k')::BIGINT END AS k,
              NULL::VARCHAR AS topic FROM events""",
)
def json_fields(t):
    wrapped = F.when(F.col("event_type") == "error", F.concat(F.lit("none "), F.translate("props", "{}", ""))).otherwise(
        F.concat(F.lit("Sure:\n"), "props", F.lit(" {\"k\": -1}"))
    )
    return t.events.select("event_id", X.json_fields(wrapped, "k bigint, topic string").alias("j")).select("event_id", "j.*")


@query(
    "fenced_json", "T19",
    "SELECT event_id, json_extract(props, '$.k')::BIGINT AS k FROM events",
)
def fenced_json(t):
    fenced = F.concat(F.lit("Here {not} it:\n```json\n"), "props", F.lit("\n```\ndone"))
    return t.events.select("event_id", F.from_json(X.fenced_json(fenced), "k bigint")["k"].alias("k"))


@query("extract_between", "T20", "SELECT doc_id, md5(text) AS digest FROM documents")
def extract_between(t):
    prompt = F.concat(F.lit("Rate this.\n\nWeb page:\n\n"), "text", F.lit("\n\n---\nNow answer."))
    return t.documents.select("doc_id", F.md5(X.extract_between(prompt)).alias("digest"))


@query(
    "fill_prompt", "T21",
    "SELECT doc_id, md5('Rate: ' || substr(text, 1, 2000) || ' in ' || 'JSON') AS digest FROM documents",
)
def fill_prompt(t):
    return t.documents.select("doc_id", F.md5(X.fill_prompt("Rate: <text> in JSON", F.col("text"))).alias("digest"))


@query(
    "normalize_answer", "T22",
    r"""WITH RECURSIVE one AS (SELECT item_id, lower(text) AS t, 0 AS i FROM benchmark
             UNION ALL SELECT item_id, regexp_replace(t, '(^|[^\p{L}\p{N}_])(a|an|the)($|[^\p{L}\p{N}_])', '\1 \3', 'g'), i + 1 FROM one WHERE i < 3)
        SELECT item_id, trim(regexp_replace(regexp_replace(t, '[^\p{L}\p{N}_ \t\n\r\f\x0B]', '', 'g'), '[ \t\n\r\f\x0B]+', ' ', 'g')) AS answer FROM one WHERE i = 3""",
)
def normalize_answer(t):
    from textquarry.functions.answers import normalize_answer as norm

    return t.benchmark.select("item_id", norm(F.col("text")).alias("answer"))


@query(
    "build_mcq", "T29",
    """WITH q AS (SELECT item_id, replace(text, 'the', '< ...>') AS question, regexp_extract_all(text, '[^ ]+')[1:4] AS options FROM benchmark)
       SELECT item_id, md5(list_aggregate(list_transform(options, lambda o: replace(question, '< ...>', o)), 'string_agg', '|')) AS choices,
              (item_id % 4)::INT AS gold_idx FROM q""",
)
def build_mcq(t):
    from textquarry.functions.answers import gold_index, mcq_choices

    items = t.benchmark.select(
        "item_id", F.replace(F.col("text"), F.lit("the"), F.lit("< ...>")).alias("question"),
        F.slice(F.split("text", " "), 1, 4).alias("options"),
        F.when(F.col("item_id") % 2 == 0, F.element_at(F.array(*[F.lit(x) for x in "ABCD"]), (F.col("item_id") % 4 + 1).cast("int")))
        .otherwise((F.col("item_id") % 4 + 1).cast("string")).alias("answer"),
    )
    return items.select(
        "item_id", F.md5(F.array_join(mcq_choices(F.col("question"), F.col("options")), "|")).alias("choices"),
        gold_index(F.col("answer")).alias("gold_idx"),
    )


@query(
    "table_to_markdown", "T30",
    r"""SELECT n_regionkey::BIGINT AS region, '| key | name |' || chr(10) || '| --- | --- |' || chr(10) ||
              string_agg('| ' || n_nationkey || ' | ' || CASE WHEN n_nationkey % 2 = 0 THEN n_name || '\|x' ELSE '' END || ' |', chr(10) ORDER BY n_nationkey) AS markdown
       FROM nation GROUP BY n_regionkey""",
)
def table_to_markdown(t):
    key = F.col("n_nationkey").cast("string")
    row = F.when(F.col("n_nationkey") % 2 == 0, F.array(key, F.concat("n_name", F.lit("|x\n")), F.lit("cut"))).otherwise(F.array(key))
    grouped = t.nation.groupBy(F.col("n_regionkey").cast("bigint").alias("region")).agg(
        F.array_sort(F.collect_list(F.struct("n_nationkey", row.alias("cells")))).alias("rows")
    )
    cells = F.concat(F.array(F.array(F.lit("key"), F.lit("name"))), F.transform("rows", lambda r: r["cells"]))
    return grouped.select("region", X.table_to_markdown(cells).alias("markdown"))


@query(
    "gold_answers", "T31",
    """SELECT item_id, CASE item_id % 3 WHEN 0 THEN w[2] WHEN 1 THEN w[3] ELSE w[1] END AS gold
       FROM (SELECT item_id, regexp_extract_all(text, '[^ ]+') AS w FROM benchmark)""",
)
def gold_answers(t):
    from textquarry.functions.answers import gold_answer

    options = F.slice(F.split("text", " "), 1, 4)
    task = F.element_at(F.array(F.lit("option_letter"), F.lit("endings"), F.lit("mc1")), (F.col("item_id") % 3 + 1).cast("int"))
    return t.benchmark.select(
        "item_id", gold_answer(task, options, letter=F.lit("B"), label=F.lit(2), targets=F.array(*[F.lit(i) for i in (1, 0, 0, 0)])).alias("gold")
    )


@query(
    "tokenize", "T32",
    f"""WITH t AS (SELECT doc_id, list_append(regexp_extract_all(text, '{X.PRETOKEN_PLAIN}'), '</s>') AS tokens FROM documents)
        SELECT doc_id, len(tokens)::INT AS n_tokens, md5(list_aggregate(tokens, 'string_agg', '|')) AS digest FROM t""",
)
def tokenize_docs(t):
    from textquarry.operators.tokens import tokenize

    out = tokenize(t.documents, pattern=X.PRETOKEN_PLAIN)
    return out.select("doc_id", "n_tokens", F.md5(F.array_join("tokens", "|")).alias("digest"))


@query("tokenize_regional", "T32")
def tokenize_regional(t):
    from textquarry.operators.tokens import tokenize

    return tokenize(t.documents).select("doc_id", "n_tokens")


@query(
    "clean_unicode", "T33",
    """WITH c AS (SELECT doc_id, nfc_normalize(replace(text, chr(13), '') || 'e' || chr(769)) AS text FROM documents)
       SELECT doc_id, length(text)::INT AS n_chars, md5(text) AS digest FROM c""",
)
def clean_unicode(t):
    from textquarry.operators.tokens import clean_unicode as clean

    return clean(t.documents.withColumn("text", F.concat("text", F.lit("é\r\u0000")))).select(
        "doc_id", F.length("text").alias("n_chars"), F.md5("text").alias("digest")
    )


@query(
    "split_sentences", "T34",
    r"""WITH s AS (SELECT doc_id, string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)) AS parts FROM documents)
        SELECT doc_id, (generate_subscripts(parts, 1) - 1)::INT AS sentence_id, unnest(parts) AS sentence FROM s""",
)
def split_sentences(t):
    return t.documents.select("doc_id", F.posexplode(X.sentences(F.col("text"))).alias("sentence_id", "sentence"))


_BARE = r"lower(regexp_replace({}, '^[^\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}.]+$', '', 'g'))"
_PERIODS = rf"""tokens AS (SELECT unnest(regexp_split_to_array(text, '\s+')) AS token FROM documents),
        bare AS (SELECT {_BARE.format('token')} AS b FROM tokens),
        seen AS (SELECT regexp_replace(b, '\.$', '') AS word, ends_with(b, '.') AS dot FROM bare WHERE b <> ''),
        counts AS (SELECT word, count(*) FILTER (dot) AS k, count(*) FILTER (NOT dot) AS r FROM seen GROUP BY word),
        usual AS (SELECT least(greatest(sum(k) / sum(k + r), 1e-9), 0.98) AS q FROM counts),
        sized AS (SELECT word, k, r, q, length(replace(word, '.', '')) AS l FROM counts, usual
                  WHERE regexp_matches(word, '^\p{{L}}[\p{{L}}.]*$')),
        periods AS (SELECT word, k, r, 2 * (k * (ln(0.99) - ln(q)) + r * (ln(0.01) - ln(1 - q)))
                           * exp(-l) * (length(word) - l + 1) * exp(-r * ln(l)) AS score FROM sized)"""


@query(
    "abbreviation_counts", "T34",
    f"""WITH {_PERIODS}
        SELECT word, k AS with_period, r AS without_period, round(score, 4) + 0.0 AS score, k >= 5 AND score >= 0.3 AS is_short
        FROM periods WHERE k > 0""",
)
def abbreviation_counts(t):
    from textquarry.operators.sentences import LEAST_SCORE, LEAST_SEEN, period_counts

    counts = period_counts(t.documents).where("with_period > 0")
    short = (F.col("with_period") >= LEAST_SEEN) & (F.col("score") >= LEAST_SCORE)
    # Adding zero makes a negative zero a plain one, here and in the twin.
    return counts.withColumn("is_short", short).withColumn("score", F.round("score", 4) + 0.0)


@query(
    "split_sentences_trained", "T34",
    rf"""WITH {_PERIODS},
        s AS (SELECT doc_id, string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)) AS parts FROM documents),
        p AS (SELECT doc_id, generate_subscripts(parts, 1) AS part, unnest(parts) AS said FROM s),
        w AS (SELECT doc_id, part, said,
                     regexp_replace({_BARE.format(r"regexp_extract(said, '(\S+)\.$', 1)")}, '\.$', '') AS word FROM p),
        m AS (SELECT doc_id, part, said, coalesce(score IS NOT NULL OR regexp_matches(w.word, '^\p{{L}}$'), FALSE) AS goes_on
              FROM w LEFT JOIN (SELECT word, score FROM periods WHERE k >= 5 AND score >= 0.3) a ON a.word = w.word AND w.word <> ''),
        i AS (SELECT doc_id, part, said, coalesce(sum((NOT goes_on)::INT) OVER (PARTITION BY doc_id ORDER BY part
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::INT AS sentence_id FROM m)
        SELECT doc_id, sentence_id, string_agg(said, ' ' ORDER BY part) AS sentence FROM i GROUP BY doc_id, sentence_id""",
)
def split_sentences_trained(t):
    from textquarry.operators.sentences import abbreviations, period_counts
    from textquarry.operators.sentences import split_sentences as split

    return split(t.documents, abbreviations(period_counts(t.documents)))


@query(
    "fit_template", "T35",
    """WITH c AS (SELECT conv_id, regexp_extract_all(text, '[^ \\n]+') AS q, turn FROM conversations),
        k AS (SELECT conv_id, turn, q, 3 + len(q) + 2 + 4 AS total FROM c)
       SELECT conv_id, turn, (CASE WHEN total > 32 THEN greatest(len(q) - (total - 32), 0) ELSE len(q) END)::INT AS kept_question,
              least(total, 32)::INT AS n_tokens FROM k""",
)
def fit_template(t):
    from textquarry.operators.tokens import fit_template as fit

    q = X.words(F.col("text"))
    rows = t.conversations.select(
        "conv_id",
        "turn",
        F.array(
            F.struct(F.lit("<template>").alias("key"), F.array(*[F.lit(w) for w in ["Context", ":", "x"]]).alias("ids")),
            F.struct(F.lit("question").alias("key"), q.alias("ids")),
            F.struct(F.lit("<template>").alias("key"), F.array(F.lit("Answer"), F.lit(":")).alias("ids")),
            F.struct(F.lit("label").alias("key"), F.array(*[F.lit(w) for w in "abcd"]).alias("ids")),
        ).alias("parts"),
    )
    # 40 tokens in all, 8 of them outside the template.
    out = fit(
        rows, "parts", max_len=40, fields=["question"], side="right", virtual_tokens=2, tokens_to_generate=3, special_tokens=3
    )
    return out.select(
        "conv_id", "turn", F.size(F.get("parts", F.lit(1))["ids"]).alias("kept_question"),
        F.aggregate("parts", F.lit(0), lambda a, p: a + F.size(p["ids"])).alias("n_tokens"),
    )


@query(
    "loss_mask_answer_only", "T36",
    """WITH w AS (SELECT conv_id, turn, len(regexp_extract_all(text, '[^ \\t\\n\\r\\f\\x0B]+')) AS n FROM conversations)
       SELECT conv_id, turn, n::INT AS n_tokens, greatest(n - 3, 0)::INT AS n_loss FROM w""",
)
def loss_mask_answer_only(t):
    from textquarry.operators.tokens import answer_loss_mask

    masked = t.conversations.select("conv_id", "turn", X.words(F.col("text")).alias("ids"))
    mask = answer_loss_mask(F.col("ids"), F.lit(3))
    return masked.select("conv_id", "turn", F.size("ids").alias("n_tokens"), F.aggregate(mask, F.lit(0), lambda a, x: a + x).alias("n_loss"))


@query(
    "loss_mask_by_role", "T36",
    """WITH w AS (SELECT conv_id, turn, role, len(regexp_extract_all(text, '[^ \\t\\n\\r\\f\\x0B]+')) AS n FROM conversations)
       SELECT conv_id, sum(n)::INT AS n_tokens, md5(string_agg(repeat(CASE WHEN role = 'assistant' THEN '1' ELSE '0' END, n::INT), '' ORDER BY turn)) AS mask
       FROM w GROUP BY conv_id""",
)
def loss_mask_by_role(t):
    from textquarry.operators.dialogue import collapse_turns
    from textquarry.operators.tokens import role_loss_mask

    convs = collapse_turns(t.conversations)
    mask = role_loss_mask(F.col("messages"))
    return convs.select("conv_id", F.size(mask).alias("n_tokens"), F.md5(F.array_join(mask, "")).alias("mask"))


@query(
    "segment_lengths", "T37",
    """WITH w AS (SELECT doc_id, regexp_extract_all(text, '[^ \\n]+') AS tokens FROM documents),
        e AS (SELECT doc_id, unnest(tokens) AS tok, generate_subscripts(tokens, 1) AS i FROM w),
        s AS (SELECT doc_id, i, sum(CASE WHEN tok = 'the' OR i = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS seg FROM e),
        l AS (SELECT doc_id, seg, count(*) AS n FROM s GROUP BY ALL)
       SELECT doc_id, coalesce(string_agg(n::VARCHAR, ',' ORDER BY seg), '') AS lengths FROM documents LEFT JOIN l USING (doc_id) GROUP BY doc_id""",
)
def segment_lengths(t):
    tokens = F.regexp_extract_all("text", F.lit(r"[^ \n]+"), F.lit(0))
    rows = t.documents.select("doc_id", tokens.alias("tokens"))
    return rows.select("doc_id", F.array_join(X.segment_lengths(F.col("tokens"), "the").cast("array<string>"), ",").alias("lengths"))


_TASKS = ["leaderboard|mmlu_all_law_cf|5", "lighteval|arc_fra_Latn_cf:easy|0", "custom|ruler_4096:_average|0", "gsm8k"]


def _sql_format_task(col: str) -> str:
    out = f"regexp_replace(CASE WHEN len(string_split({col}, '|')) IN (2, 3) THEN string_split({col}, '|')[2] ELSE {col} END, '_cf$', '')"
    for old, new in L.TASK_NAMES:
        out = f"replace({out}, '{old}', '{new}')"
    return f"trim({out})"


@query(
    "display_names", "T38",
    f"""WITH x AS (SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, {S.pick(_TASKS, 'l_orderkey', 'l_linenumber')} AS task,
                  l_extendedprice * pow(10, l_linenumber - 2) AS tokens FROM lineitem)
        SELECT l_orderkey, l_linenumber, {_sql_format_task('task')} AS task,
               CASE WHEN tokens >= 1e12 THEN printf('%.2f T', tokens / 1e12) WHEN tokens >= 1e9 THEN printf('%.1f B', tokens / 1e9)
                    WHEN tokens >= 1e6 THEN printf('%.1f M', tokens / 1e6) WHEN tokens >= 1e3 THEN printf('%.1f K', tokens / 1e3)
                    WHEN tokens > 0 THEN printf('%.1f', tokens) ELSE '' END AS tokens FROM x""",
)
def display_names(t):
    from textquarry.functions.hashing import pick

    task = pick(_TASKS, "l_orderkey", "l_linenumber")
    tokens = F.col("l_extendedprice") * F.pow(F.lit(10.0), F.col("l_linenumber") - 2)
    return t.lineitem.select(
        "l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"),
        L.format_task(task).alias("task"), L.format_tokens(tokens).alias("tokens"),
    )


@query(
    "dataset_classes", "T39",
    """SELECT doc_id, CASE WHEN source = 'src1' THEN 'cot' WHEN source = 'src2' THEN 'math' WHEN lang IN ('de', 'es') THEN 'euro/arab' ELSE lang END AS family,
              CASE WHEN source = 'src3' THEN 'web' ELSE 'no_web' END AS web FROM documents""",
)
def dataset_classes(t):
    name = (
        F.when(F.col("source") == "src1", "nemotron-post-think").when(F.col("source") == "src2", "numina-math")
        .when(F.col("source") == "src3", "fineweb2").otherwise(F.col("source"))
    )
    return t.documents.select(
        "doc_id", L.language_family(L.dataset_language(name, F.col("lang"))).alias("family"), L.web_label(name).alias("web")
    )
