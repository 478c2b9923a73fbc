"""Queries of the engine's own operators, each over its whole tables, with equivalent SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltstone.config import Config, Quality
from siltstone.functions import arrow, embed, markers, parse
from siltstone.functions import text as fn
from siltstone.io import table, tune
from siltstone.models.clients import Asker, Template
from siltstone.operators import answers, filters, metrics, questions, similarity, state
from siltstone.plans import pipeline

QUERIES, SQL = {}, {}

# White space as Unicode has it, for an engine whose patterns know only ASCII space.
SPACE = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def stripped(column: str) -> str:
    return f"regexp_replace({column}, '^{SPACE}+|{SPACE}+$', '', 'g')"


def n_words(column: str) -> str:
    return f"len(list_filter(regexp_split_to_array(coalesce({column}, ''), '{SPACE}+'), lambda x: x <> ''))"


def normal(column: str) -> str:
    return f"lower(trim(regexp_replace(coalesce({column}, ''), '{SPACE}+', ' ', 'g')))"


QA = "qa as (select * from qa_pairs qualify row_number() over (partition by pair_id order by ingested_at desc) = 1)"
DOCS = "d as (select * from docs qualify row_number() over (partition by doc_id order by loaded_at desc) = 1)"
CHUNKS = "c as (select doc_id, chunk_ix, max(content) as content, max(score) as score from chunks group by doc_id, chunk_ix)"
WORD = r"[\p{L}\p{N}_]+"


def query(sql: str | None = None):
    """Registers a query under its function's name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def qa(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """Question-answer pairs, the latest delivery of each, with some columns."""
    rows = table(tune(spark), d, "qa_pairs", "pair_id", "ingested_at", *columns)
    return rows.groupBy("pair_id").agg(F.max_by(F.struct(*columns), "ingested_at").alias("r")).select("pair_id", "r.*")


def docs(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    rows = table(tune(spark), d, "docs", "doc_id", "loaded_at", *[c for c in columns if c != "loaded_at"])
    return rows.groupBy("doc_id").agg(F.max_by(F.struct(*columns), "loaded_at").alias("r")).select("doc_id", "r.*")


def chunks(spark: SparkSession, d: str) -> DataFrame:
    rows = table(tune(spark), d, "chunks", "doc_id", "chunk_ix", "content", "score")
    return rows.groupBy("doc_id", "chunk_ix").agg(F.max("content").alias("content"), F.max("score").alias("score"))


# --- text -------------------------------------------------------------------------------------------------------

_CLEAN = f"trim(regexp_replace(coalesce(text, ''), '{SPACE}+', ' ', 'g'))"


@query(f"select doc_id, case when length({_CLEAN}) < 10 then '' else substr({_CLEAN}, 1, 100000) end as clean from documents")
def clean_text(spark, d):
    return table(tune(spark), d, "documents", "doc_id", "text").select("doc_id", fn.clean_text(F.col("text")).alias("clean"))


@query(f"select coalesce(lang, '') as lang, count(*) as n, count(*) filter (length({_CLEAN}) < 10) as emptied, cast(sum(floor(length(text) / 4)) as bigint) as tokens from documents group by 1")
def token_totals(spark, d):
    t = table(tune(spark), d, "documents", "lang", "text")
    return t.groupBy(F.coalesce("lang", F.lit("")).alias("lang")).agg(F.count("*").alias("n"), F.count_if(fn.clean_text(F.col("text")) == "").alias("emptied"), F.sum(fn.token_estimate(F.col("text"))).alias("tokens"))


@query(f"with {DOCS} select doc_id, regexp_replace(content, '<[^>]+>', '', 'g') as stripped from d")
def tags_stripped(spark, d):
    return docs(spark, d, "content").select("doc_id", fn.strip_tags(F.col("content")).alias("stripped"))


@query(f"""with {DOCS}, s as (select doc_id, lower(regexp_extract(source, '(\\.[^./\\\\]+)$', 1)) as suffix from d)
select doc_id, case when suffix in {fn.TEXT_SUFFIXES} then 'text' when suffix in {fn.IMAGE_SUFFIXES} then 'image' end as kind from s""")
def file_types(spark, d):
    return docs(spark, d, "source").select("doc_id", fn.file_type(F.col("source")).alias("kind"))


@query(f"""with recursive w as (select doc_id, text, list_filter(regexp_split_to_array(text, '{SPACE}+'), lambda x: x <> '') as w from documents where text is not null),
s as (select doc_id, w, len(w) as n, list_filter(range(0, len(w)), lambda i: w[i + 1][-1] in ('.', '!', '?')) as stops from w where len(w) > 512),
f(doc_id, ix, a, b) as (
  select doc_id, 0, 0, coalesce(list_max(list_filter(stops, lambda i: i <= least(532, n - 1) and i > 492)) + 1, 512) from s
  union all
  select f.doc_id, f.ix + 1, greatest(f.a + 1, f.b - 50),
    case when greatest(f.a + 1, f.b - 50) + 512 >= s.n then s.n else coalesce(list_max(list_filter(s.stops, lambda i: i <= least(greatest(f.a + 1, f.b - 50) + 532, s.n - 1) and i > greatest(greatest(f.a + 1, f.b - 50) + 492, greatest(f.a + 1, f.b - 50)))) + 1, greatest(f.a + 1, f.b - 50) + 512) end
  from f join s using (doc_id) where f.b < s.n or f.a + 512 < s.n)
select f.doc_id, cast(ix as integer) as chunk_ix, array_to_string(w[a + 1 : b], ' ') as content from f join s using (doc_id)
union all select doc_id, 0, text from w where len(w) <= 512""")
def word_chunks(spark, d):
    return arrow.chunked(table(tune(spark), d, "documents", "doc_id", "text"), "doc_id", "text", "words")


@query()
def char_chunks(spark, d):
    return arrow.chunked(table(tune(spark), d, "documents", "doc_id", "text"), "doc_id", "text", "chars")


@query(f"""with {DOCS}, l as (select doc_id, unnest(string_split(content, chr(10))) as line, generate_subscripts(string_split(content, chr(10)), 1) as i from d where content is not null),
k as (select *, starts_with(line, '[') and regexp_matches(line, 'OCR Text:|Image Caption:|Detected Objects:|Scene Description:|Visual Analysis:|Visual Context:') as marker from l where {stripped("line")} <> ''),
t as (select *, not marker and starts_with(line, '===') as title from k),
s as (select *, sum(cast(marker or title as integer)) over (partition by doc_id order by i) as section_no from t)
select doc_id, cast(section_no as bigint) as section_no,
  case when bool_or(marker or (title and contains(line, 'Visual Content'))) then 'visual' when bool_or(not marker and not title and contains(line, '[Visual Context:')) then 'combined' else 'text' end as type,
  string_agg(line, chr(10) order by i) filter (not title) as text
from s group by doc_id, section_no having count(*) filter (not title) > 0""")
def content_sections(spark, d):
    return markers.sections(docs(spark, d, "content"))


@query(f"""with {DOCS}, p as (select doc_id, unnest(string_split(coalesce(content, ''), chr(10) || chr(10))) as p, generate_subscripts(string_split(coalesce(content, ''), chr(10) || chr(10)), 1) as i from d),
x as (select doc_id, i * 3 as o, p as t from p where not (starts_with(p, '[OCR Text:') or starts_with(p, '[Image Caption:'))
union all select doc_id, i * 3 + 1, regexp_extract(p, '\\[OCR Text: (.*?)\\]', 1) from p where regexp_matches(p, '\\[OCR Text: (.*?)\\]')
union all select doc_id, i * 3 + 2, regexp_extract(p, '\\[Image Caption: (.*?)\\]', 1) from p where regexp_matches(p, '\\[Image Caption: (.*?)\\]'))
select doc_id, string_agg(t, chr(10) || chr(10) order by o) as text from x group by doc_id""")
def extracted_text(spark, d):
    return docs(spark, d, "content").select("doc_id", markers.all_text(F.col("content")).alias("text")).where("text is not null")


def _marker_sql(no: int, marker: str, subtype: str, score: float) -> str:
    found = f"regexp_extract_all(coalesce(content, ''), '\\[{marker}(?: at [^:\\]]*)?:([^\\]]+)\\]', 1)"
    return f"select doc_id, {no} as kind_no, unnest(range(0, len({found}))) as n, unnest({found}) as body, '{subtype}' as subtype, cast({score} as double) as score from d"


_VISUAL = f"""m as ({_marker_sql(1, "OCR Text", "ocr_text", 0.8)} union all {_marker_sql(2, "Image Caption", "caption", 0.9)} union all {_marker_sql(3, "Detected Objects", "objects", 0.85)} union all {_marker_sql(4, "Scene Description", "scene", 0.9)} union all {_marker_sql(5, "Visual Analysis", "analysis", 0.85)}),
b as (select doc_id, kind_no, n, {stripped("body")} as body, subtype, score from m),
o as (select doc_id, kind_no, n, array_to_string(list_transform(list_filter(list_transform(string_split(body, ','), lambda e: {stripped("e")}), lambda e: coalesce(try_cast(regexp_extract(e, '\\(([0-9]*\\.?[0-9]+)\\)$', 1) as double), 0) > 0.7), lambda e: {stripped("regexp_replace(e, '\\([^()]*\\)$', '')")}), ', ') as body, subtype, score from b where kind_no = 3),
a as (select doc_id, n, unnest(string_split(body, '|')) as p, generate_subscripts(string_split(body, '|'), 1) as m, score from b where kind_no = 5),
v as (select doc_id, body as text, subtype, score, cast(null as varchar) as question, kind_no, n, 0 as m from b where kind_no in (2, 4) or kind_no = 1 and length(body) >= 3
union all select doc_id, body, subtype, score, null, kind_no, n, 0 from o where body <> ''
union all select doc_id, {stripped("substr(p, position('->' in p) + 2)")}, 'analysis', score, {stripped("substr(p, 1, position('->' in p) - 1)")}, 5, n, m from a where contains(p, '->'))"""


@query(f"with {DOCS}, {_VISUAL} select doc_id, text, subtype, score, question from v")
def visual_answers(spark, d):
    return markers.visual_answers(docs(spark, d, "content")).select("doc_id", "text", "subtype", "score", "question")


@query(f"""with {DOCS}, {_VISUAL}, r as (select doc_id, text, subtype, score * case when len(list_filter(regexp_split_to_array(text, '{SPACE}+'), lambda x: x <> '')) between 5 and 15 then 1.1 else 1.0 end as rank from v),
t as (select *, row_number() over (partition by doc_id order by rank desc, subtype, text) as place from r)
select doc_id, text, subtype, round(rank, 6) as ranking_score, place from t where place <= 3""")
def top_visual_answers(spark, d):
    v = markers.visual_answers(docs(spark, d, "content")).withColumn("rank", answers.answer_rank(F.col("score"), F.col("type"), F.col("text")))
    w = Window.partitionBy("doc_id").orderBy(F.desc("rank"), "subtype", "text")
    return v.withColumn("place", F.row_number().over(w)).where("place <= 3").select("doc_id", "text", "subtype", F.round("rank", 6).alias("ranking_score"), "place")


@query(f"""with {DOCS}, {_VISUAL} select doc_id, concat_ws('_', 'visual', subtype) as kind, count(*) as n, round(max(score), 6) as best from v group by 1, 2""")
def answers_by_kind(spark, d):
    v = markers.visual_answers(docs(spark, d, "content"))
    return v.groupBy("doc_id", F.concat_ws("_", "type", "subtype").alias("kind")).agg(F.count("*").alias("n"), F.round(F.max("score"), 6).alias("best"))


@query()
def text_answer_candidates(spark, d):
    return answers.text_answers(docs(spark, d, "content"))


@query()
def ranked_answers(spark, d):
    return answers.ranked(answers.filtered(answers.all_answers(docs(spark, d, "content")))).select("doc_id", "seq", "text", "type", "subtype", F.round("ranking_score", 6).alias("ranking_score"), "place")


_TEMPLATES = ", ".join("(" + ", ".join([f"'{c}'", f"'{s}'", str(i), "'" + t.replace("'", "''") + "'"]) + ")" for (c, s), ts in questions.TEMPLATES.items() for i, t in enumerate(ts))


@query(f"""with {DOCS}, {_VISUAL}, t(category, subtype, ix, template) as (values {_TEMPLATES})
select doc_id, cast(ix as integer) as ix, replace(replace(template, '{{answer}}', text), '{{context}}', 'this passage') as question, text as answer from v join t on t.category = 'visual' and t.subtype = v.subtype where v.question is null
union all select doc_id, 0, question, text from v where question is not null""")
def template_questions(spark, d):
    v = markers.visual_answers(docs(spark, d, "content")).withColumn("seq", F.row_number().over(Window.partitionBy("doc_id").orderBy("kind_no", "n")))
    return questions.from_templates(v).select("doc_id", "ix", "question", "answer")


#: Documents in which a phrase of their own is named as a visual context, and an OCR marker stands beside it.
_PHRASE = "([A-Za-z]{5,} [a-z]{3,})"
PLANTED = DOCS.replace("d as (", "d0 as (", 1) + f""", d1 as (select doc_id, content, regexp_extract(content, '{_PHRASE}', 1) as phrase from d0),
d as (select doc_id, content || chr(10) || chr(10) || '[OCR Text: ' || phrase || '] [Visual Context: ' || phrase || ']' as content from d1 where phrase <> '')"""


def planted(spark, d: str) -> DataFrame:
    x = docs(spark, d, "content").withColumn("phrase", F.regexp_extract("content", _PHRASE, 1)).where("phrase <> ''")
    return x.select("doc_id", F.concat("content", F.lit("\n\n[OCR Text: "), "phrase", F.lit("] [Visual Context: "), "phrase", F.lit("]")).alias("content"))


_RELATED = f"""rc as (select doc_id, string_split(content, chr(10) || chr(10)) as p, unnest(regexp_extract_all(content, '\\[Visual Context:([^\\]]+)\\]', 1)) as c, generate_subscripts(regexp_extract_all(content, '\\[Visual Context:([^\\]]+)\\]', 1), 1) as n from d),
re as (select doc_id, p, n, {stripped("c")} as c, unnest(p) as para, generate_subscripts(p, 1) as i from rc),
rel as (select doc_id, cast(n - 1 as integer) as n, cast(i - 1 as integer) as place, c as context, array_to_string(p[greatest(i - 3, 1) : i + 3], chr(10) || chr(10)) as related from re where contains(para, c))"""


@query(f"with {PLANTED}, {_RELATED} select * from rel")
def related_paragraphs(spark, d):
    return answers.related_paragraphs(planted(spark, d))


@query(f"""with {PLANTED}, {_RELATED}, {_VISUAL} select v.doc_id, v.text || ' (Visual) - Related to: ' || context as text, 'text_' || subtype as subtype, round((score + 0.9) / 2, 6) as score, related as context
from rel join v on rel.doc_id = v.doc_id and contains(related, v.text)""")
def combined_answers(spark, d):
    return answers.combined_answers(planted(spark, d)).select("doc_id", "text", "subtype", F.round("score", 6).alias("score"), "context")


@query(f"""with {DOCS}, x as (select doc_id, content, metadata.original_images as im, metadata.relationships as rl from d),
p as (select doc_id, unnest(string_split(coalesce(content, ''), chr(10) || chr(10))) as t, generate_subscripts(string_split(coalesce(content, ''), chr(10) || chr(10)), 1) - 1 as i from x),
r as (select doc_id, im, unnest(rl) as r, generate_subscripts(rl, 1) as k from x),
l as (select doc_id, i, 0 as k, t from p union all
  select p.doc_id, p.i, r.k, concat_ws(chr(10) || chr(10), case when r.r.context is not null then chr(10) || '[Visual Context: ' || r.r.context || ']' end, '[Image Caption: ' || r.r.target || ']')
  from p join r on r.doc_id = p.doc_id and regexp_extract(r.r.source, '^(?:paragraph|page)_(\\d+)$', 1) = cast(p.i as varchar) where list_contains(r.im, r.r.target)),
inside as (select doc_id, string_agg(t, chr(10) || chr(10) order by i, k) as t from l group by doc_id)
select doc_id, case when im is null or len(im) = 0 then content
  when rl is null or len(rl) = 0 then concat_ws(chr(10) || chr(10), case when coalesce(content, '') <> '' then '=== Document Text ===' || chr(10) || content end, '=== Visual Content ===' || chr(10) || array_to_string(list_transform(im, lambda i: '[Image Caption: ' || i || ']'), chr(10) || chr(10)))
  else inside.t end as merged from x join inside using (doc_id)""")
def merged_images(spark, d):
    x = docs(spark, d, "content", "metadata")
    images = F.transform("metadata.original_images", lambda i: F.struct(i.alias("target"), F.concat(F.lit("[Image Caption: "), i, F.lit("]")).alias("section")))
    return x.select("doc_id", markers.merge_images(F.col("content"), images, F.col("metadata.relationships")).alias("merged"))


_CLASS = "case when regexp_matches(lq, '^(?:who|whose|whom|wer|qui|quién)(?:[^\\p{L}]|$)') then 'HUMAN' when regexp_matches(lq, '^(?:where|wo|où|dónde)(?:[^\\p{L}]|$)') then 'LOCATION' when regexp_matches(lq, '^(?:when|how many|how much|wann|wie oft|combien|quand|cuándo|cuántas)(?:[^\\p{L}]|$)') then 'NUMERIC' when regexp_matches(lq, '^(?:why|how|describe|explain|warum|beschreibe|pourquoi|cómo)(?:[^\\p{L}]|$)') then 'DESCRIPTION' else 'ENTITY' end"


def _text_near_sql(source: str, group: str, order: str, text: str, threshold: float) -> str:
    """CTEs up to ``n(grp, ord, i, nb)``: items of each group in order, with the numbers of those that are near them."""
    return f"""i as (select {group} as grp, {order} as ord, {text} as text, row_number() over (partition by {group} order by {order}) as i from {source}),
t as (select grp, i, w, count(*) as n from (select grp, i, unnest(regexp_extract_all(lower(coalesce(text, '')), '{WORD}')) as w from i) group by all), s as (select grp, i, sum(n * n) as s from t group by all),
p as (select a.grp, a.i, b.i as j, sum(a.n * b.n) as dot from t a join t b on a.grp = b.grp and a.w = b.w and a.i <> b.i group by all),
q as (select p.grp, p.i, p.j from p join s x on x.grp = p.grp and x.i = p.i join s y on y.grp = p.grp and y.i = p.j where p.dot / sqrt(cast(x.s as double) * y.s) > {threshold}),
n as (select i.grp, i.ord, i.i, coalesce(list(q.j) filter (q.j is not null), []) as nb from i left join q on i.grp = q.grp and i.i = q.i group by all)"""


@query(f"""with recursive {DOCS}, {_VISUAL}, tt(category, subtype, ix, template) as (values {_TEMPLATES}), sq as (select doc_id, text, subtype, score, question, row_number() over (partition by doc_id order by kind_no, n, m) as seq from v),
fq as (select doc_id, seq * 10 + ix as seq, score, replace(replace(template, '{{answer}}', text), '{{context}}', 'this passage') as question from sq join tt on tt.category = 'visual' and tt.subtype = sq.subtype where question is null union all select doc_id, seq * 10, score, question from sq where question is not null),
fit as (select * from fq where score >= 0.6 and {n_words('question')} between 3 and 50), {_text_near_sql("fit", "doc_id", "seq", "question", 0.85)},
f(grp, i, kept) as (select distinct grp, 0::bigint, []::bigint[] from n union all select n.grp, n.i, case when len(list_intersect(f.kept, n.nb)) > 0 then f.kept else list_append(f.kept, n.i) end from f join n on n.grp = f.grp and n.i = f.i + 1),
kk as (select fit.*, trim(lower(fit.question)) as lq from n join f on n.grp = f.grp and f.i = n.i join fit on fit.doc_id = n.grp and fit.seq = n.ord where list_contains(f.kept, n.i)),
kr as (select doc_id, seq, question, score * case {_CLASS} when 'DESCRIPTION' then 1.2 when 'ENTITY' then 1.1 when 'NUMERIC' then 0.9 else 1.0 end::double * 1.1::double as rank from kk),
kp as (select *, row_number() over (partition by doc_id order by rank desc, seq) as place from kr) select doc_id, seq, question, round(rank, 6) as ranking_score, place from kp where place <= 50""")
def ranked_questions(spark, d):
    v = markers.visual_answers(docs(spark, d, "content")).withColumn("seq", F.row_number().over(Window.partitionBy("doc_id").orderBy("kind_no", "n")))
    q = questions.from_templates(v).join(v.select("doc_id", "seq", "score"), ["doc_id", "seq"]).withColumn("seq", F.col("seq") * 10 + F.col("ix"))
    return questions.ranked_questions(q).select("doc_id", "seq", "question", F.round("ranking_score", 6).alias("ranking_score"), "place")



@query()
def model_questions(spark, d):
    """Questions of all kinds: templates, and what the stand-in model asks and refines, ranked."""
    found = answers.filtered(answers.all_answers(docs(spark, d, "content")))
    return questions.generated(found, Asker()).select("doc_id", "seq", "question", "category", F.round("ranking_score", 6).alias("ranking_score"), "place")


# --- replies ----------------------------------------------------------------------------------------------------

_TRIPLET = "concat('---START_TRIPLET---', chr(10), 'QUESTION: ', coalesce(question, ''), chr(10), 'ANSWER: ', coalesce(answer, ''), chr(10), 'INSTRUCTION: ', coalesce(instruction, ''), chr(10), case when pair_id % 7 = 0 then '' else '---END_TRIPLET---' end)"


def _last(field: str, body: str = "body") -> str:
    found = f"regexp_extract_all({body}, '(?m)^[ \\t]*{field}:[ \\t]*([^\\n]*)$', 1)"
    return f"case when len({found}) > 0 then {stripped(found + '[-1]')} end"


@query(f"""with {QA}, r as (select pair_id, {_TRIPLET} as reply from qa), p as (select pair_id, unnest(string_split(reply, '---START_TRIPLET---')) as part from r),
b as (select pair_id, {stripped("string_split(part, '---END_TRIPLET---')[1]")} as body from p where contains(part, '---END_TRIPLET---')),
f as (select pair_id, {_last("QUESTION")} as question, {_last("ANSWER")} as answer, {_last("INSTRUCTION")} as instruction from b)
select * from f where question <> '' and answer <> '' and instruction <> ''""")
def parsed_triplets(spark, d):
    x = qa(spark, d, "question", "answer", "instruction")
    reply = F.concat(F.lit("---START_TRIPLET---\nQUESTION: "), F.coalesce("question", F.lit("")), F.lit("\nANSWER: "), F.coalesce("answer", F.lit("")), F.lit("\nINSTRUCTION: "), F.coalesce("instruction", F.lit("")), F.lit("\n"), F.when(F.col("pair_id") % 7 == 0, "").otherwise("---END_TRIPLET---"))
    return parse.parse_triplets(x.select("pair_id", reply.alias("reply"))).drop("triplet_no")


def _records_sql(reply: str, starts: str, blank: bool, fields: dict[str, str], where: str, select: str) -> str:
    line = stripped("raw")
    begins = f"starts_with(line, '{starts}')" + (" or line = ''" if blank else "")
    parts = ", ".join(f"arg_max({stripped(f'substr(line, {len(name) + 1})')}, i) filter (starts_with(line, '{name}')) as {alias}" for name, alias in fields.items())
    return f"""with {QA}, r as (select pair_id, {reply} as reply from qa),
l as (select pair_id, unnest(string_split(reply, chr(10))) as raw, generate_subscripts(string_split(reply, chr(10)), 1) as i from r),
s as (select pair_id, i, {line} as line from l), n as (select *, sum(cast({begins} as integer)) over (partition by pair_id order by i) as record from s),
g as (select pair_id, cast(record as bigint) as record, {parts} from n where line <> '' group by pair_id, record)
select {select} from g where {where}"""


_NUM = "'^[+-]?(?:\\d+\\.?\\d*|\\.\\d+)(?:[eE][+-]?\\d+)?$'"
_SCORE = f"case when c is not null then coalesce(case when regexp_matches(c, {_NUM}) then try_cast(c as double) end, 0.8) end"


def _reply(*parts):
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _c(name: str):
    return F.coalesce(F.col(name), F.lit(""))


@query(_records_sql("concat('Q: ', coalesce(question, ''), chr(10), 'A: ', coalesce(answer, ''), chr(10), 'Q: ', coalesce(instruction, ''), chr(10), '  A:', coalesce(answer, ''))", "Q:", False, {"Q:": "question", "A:": "answer"}, "question <> '' and answer <> ''", "pair_id, record, question, answer"))
def parsed_qa_lines(spark, d):
    x = qa(spark, d, "question", "answer", "instruction")
    return parse.parse_qa_lines(x.select("pair_id", _reply("Q: ", _c("question"), "\nA: ", _c("answer"), "\nQ: ", _c("instruction"), "\n  A:", _c("answer")).alias("reply")))


@query(_records_sql("concat('Answer: ', coalesce(answer, ''), chr(10), 'Reasoning: ', coalesce(instruction, ''), chr(10), 'Confidence: ', case when pair_id % 3 = 0 then 'high' else cast(pair_id % 10 / 10.0 as varchar) end, chr(10), 'Type: FACT', chr(10), chr(10), 'Type: entity', chr(10), 'Answer: ', coalesce(question, ''))", "Answer:", True, {"Answer:": "text", "Reasoning:": "reasoning", "Confidence:": "c", "Type:": "t"}, "text <> ''", f"pair_id, record, text, reasoning, {_SCORE} as score, lower(t) as type"))
def parsed_answers(spark, d):
    x = qa(spark, d, "question", "answer", "instruction")
    conf = F.when(F.col("pair_id") % 3 == 0, "high").otherwise((F.col("pair_id") % 10 / 10.0).cast("string"))
    return parse.parse_answers(x.select("pair_id", _reply("Answer: ", _c("answer"), "\nReasoning: ", _c("instruction"), "\nConfidence: ", conf, "\nType: FACT\n\nType: entity\nAnswer: ", _c("question")).alias("reply")))


@query(_records_sql("concat('Question Type: Factual', chr(10), 'Question: ', coalesce(question, ''), chr(10), 'Verification: ', coalesce(instruction, ''), chr(10), 'Complexity: ', case when pair_id % 4 = 0 then '' else '0.5' end, chr(10), chr(10), 'Question: ', coalesce(instruction, ''))", "Question Type:", True, {"Question:": "question", "Question Type:": "t", "Verification:": "verification", "Complexity:": "c"}, "question <> ''", f"pair_id, record, question, lower(t) as type, verification, {_SCORE} as score"))
def parsed_questions(spark, d):
    x = qa(spark, d, "question", "instruction")
    level = F.when(F.col("pair_id") % 4 == 0, "").otherwise("0.5")
    return parse.parse_questions(x.select("pair_id", _reply("Question Type: Factual\nQuestion: ", _c("question"), "\nVerification: ", _c("instruction"), "\nComplexity: ", level, "\n\nQuestion: ", _c("instruction")).alias("reply")))


_REFINE = "concat('Original: ', coalesce(question, ''), chr(10), 'Improved: ', coalesce(instruction, ''), chr(10), 'Reasoning: shorter', chr(10), 'Keep/Replace: ', case when pair_id % 2 = 0 then 'Replace' else 'keep' end)"


@query(_records_sql(_REFINE, "Original:", True, {"Original:": "original", "Improved:": "improved", "Keep/Replace:": "d"}, "original <> '' and improved <> ''", "pair_id, case when lower(d) = 'replace' then improved else original end as question, lower(d) as decision"))
def refined_questions(spark, d):
    x = qa(spark, d, "question", "instruction").withColumn("seq", F.lit(1))
    decision = F.when(F.col("pair_id") % 2 == 0, "Replace").otherwise("keep")
    r = parse.parse_refinements(x.select("pair_id", _reply("Original: ", _c("question"), "\nImproved: ", _c("instruction"), "\nReasoning: shorter\nKeep/Replace: ", decision).alias("reply")))
    refined = parse.refine_questions(x.select("pair_id", "seq", fn.strip(F.col("question")).alias("question")), r)
    return refined.join(r.select("pair_id", "decision"), "pair_id").select("pair_id", "question", "decision")


@query(f"with v as (select pair_id, attempt, max(response) as response from verdicts group by all) select pair_id, attempt, coalesce(lower(regexp_extract(concat('Valid: ', case when contains(response, 'true') then 'True' else 'no' end, chr(10), 'Valid: true'), '(?m)^[ \\t]*Valid:[ \\t]*(\\S*)', 1)) = 'true', false) as valid from v")
def boolean_verdicts(spark, d):
    v = table(tune(spark), d, "verdicts", "pair_id", "attempt", "response").groupBy("pair_id", "attempt").agg(F.max("response").alias("response"))
    reply = F.concat(F.lit("Valid: "), F.when(F.col("response").contains("true"), "True").otherwise("no"), F.lit("\nValid: true"))
    return v.select("pair_id", "attempt", parse.boolean_verdict(reply).alias("valid"))


@query(f"""with v as (select pair_id, attempt, regexp_extract(coalesce(response, ''), '"question_quality": ?([^,}}]*)', 1) as reply from verdicts)
select distinct pair_id, attempt, coalesce(case when regexp_matches({stripped("reply")}, {_NUM}) then greatest(0.0, least(1.0, try_cast({stripped("reply")} as double))) end, 0.5) as density from v""")
def densities(spark, d):
    v = table(tune(spark), d, "verdicts", "pair_id", "attempt", "response")
    reply = F.regexp_extract(F.coalesce("response", F.lit("")), '"question_quality": ?([^,}]*)', 1)
    return v.select("pair_id", "attempt", parse.density(reply).alias("density")).distinct()


_J = "(case when json_valid(j) then cast(j as json) end)"


@query(f"""with v as (select distinct pair_id, attempt, nullif(regexp_extract(coalesce(response, ''), '(?s)\\{{.*\\}}', 0), '') as j from verdicts),
k as (select pair_id, attempt, {_J} as j from v),
w as (select *, coalesce(json_type(j, '$.valid') = 'BOOLEAN' and json_type(j, '$.issues') = 'ARRAY' and json_type(j, '$.improvements') = 'ARRAY'
  and json_type(j, '$.scores.answer_validity') in ('BIGINT', 'UBIGINT', 'DOUBLE') and json_type(j, '$.scores.question_quality') in ('BIGINT', 'UBIGINT', 'DOUBLE') and json_type(j, '$.scores.instruction_quality') in ('BIGINT', 'UBIGINT', 'DOUBLE')
  and len(list_filter(json_keys(j, '$.scores'), lambda x: json_type(j, '$.scores.' || x) not in ('BIGINT', 'UBIGINT', 'DOUBLE') or not coalesce(try_cast(json_extract_string(j, '$.scores.' || x) as double), -1) between 0 and 1)) = 0, false) as well_formed from k)
select pair_id, attempt, well_formed, case when well_formed then cast(json_extract_string(j, '$.scores.answer_validity') as double) end as answer_validity, case when well_formed then cast(json_extract_string(j, '$.valid') as boolean) end as valid from w""")
def verdict_checks(spark, d):
    v = table(tune(spark), d, "verdicts", "pair_id", "attempt", "response")
    return parse.parse_verdicts(v).select("pair_id", "attempt", "well_formed", "answer_validity", "valid").distinct()


# --- filters ----------------------------------------------------------------------------------------------------



@query(f"with {QA} select pair_id, {n_words('question')} as question_words, {n_words('answer')} as answer_words from qa where {n_words('question')} between 10 and 50 and {n_words('answer')} between 5 and 100")
def length_filter(spark, d):
    x = qa(spark, d, "question", "answer")
    return x.where(filters.lengths_fit(F.col("question"), F.col("answer"))).select("pair_id", fn.word_count(F.col("question")).cast("bigint").alias("question_words"), fn.word_count(F.col("answer")).cast("bigint").alias("answer_words"))


def _miss(c: str) -> str:
    return f"case when {stripped(f'coalesce({c}, {chr(39) * 2})')} = '' then '{c}' end"


_ROUTE = f"""with {QA}, m as (select pair_id, source, concat_ws(',', {_miss('question')}, {_miss('answer')}, {_miss('instruction')}) as missing, validation_scores as s from qa),
z as (select *, list_min(list_transform(['answer_validity', 'question_quality', 'instruction_quality'], lambda k: case when s[k] is null or isnan(s[k]) then 0 else s[k] end)) as low from m),
r as (select pair_id, missing, case when missing <> '' then 'missing_fields' when s is null then 'no_verdict' when low < 0.7 then 'low_scores' end as reason from z)"""


@query(_ROUTE + " select pair_id, missing, reason from r")
def routed_pairs(spark, d):
    return filters.route(qa(spark, d, "question", "answer", "instruction", "validation_scores")).select("pair_id", "missing", "reason")


@query(_ROUTE + " select coalesce(reason, 'accepted') as outcome, count(*) as n from r group by 1")
def route_counts(spark, d):
    return filters.route(qa(spark, d, "question", "answer", "instruction", "validation_scores")).groupBy(F.coalesce("reason", F.lit("accepted")).alias("outcome")).agg(F.count("*").alias("n"))


@query("select distinct doc_id, " + ", ".join(f"not regexp_matches(coalesce(text, '') || ' ', '{p}') as {k}" for k, p in filters.CONTENT.items()) + " from documents")
def content_filters(spark, d):
    t = table(tune(spark), d, "documents", "doc_id", "text")
    return t.select("doc_id", *[filters.content_ok(F.col("text"), F.lit(""), (k,)).alias(k) for k in filters.CONTENT])


_A, _C, _Q = stripped("lower(coalesce(answer, ''))"), "lower(coalesce(context, ''))", stripped("coalesce(question, '')")


@query(f"""with {QA}, x as (select pair_id, {_Q} as q, {_A} as a, {_C} as c from qa), w as (select *, list_filter(regexp_split_to_array(a, '{SPACE}+'), lambda y: y <> '') as w from x)
select pair_id, q <> '' and a <> '' and ends_with(q, '?') and case when len(w) <= 3 then contains(c, a) else len(list_filter(w, lambda y: contains(c, y))) / greatest(len(w), 1) >= 0.8 end as valid from w""")
def pair_checks(spark, d):
    return qa(spark, d, "question", "answer", "context").select("pair_id", filters.pair_valid(F.col("question"), F.col("answer"), F.col("context")).alias("valid"))




@query(f"""with {QA}, x as (select pair_id, {normal('context')} as t, {normal('answer')} as a from qa), o as (select pair_id, a, list_filter(string_split(t, ' '), lambda y: y <> '') as w, len(list_filter(string_split(a, ' '), lambda y: y <> '')) as n from x where not contains(t, a)),
ac as (select pair_id, w, count(*) as n from (select pair_id, unnest(regexp_extract_all(a, '{WORD}')) as w from o) group by all), na as (select pair_id, sum(n * n) as s from ac group by pair_id),
t as (select pair_id, n, len(w) as len, unnest(w) as word, generate_subscripts(w, 1) as i from o), k as (select pair_id, n, len, i, unnest(regexp_extract_all(word, '{WORD}')) as w from t),
ws as (select pair_id, s, w, count(*) as c from (select pair_id, w, unnest(range(greatest(1, i - n + 1), least(i, len - n + 1) + 1)) as s from k) group by all),
m as (select ws.pair_id, ws.s, sum(ws.c * coalesce(ac.n, 0)) as dot, sum(ws.c * ws.c) as sq from ws left join ac on ac.pair_id = ws.pair_id and ac.w = ws.w group by all),
h as (select distinct m.pair_id from m join na on na.pair_id = m.pair_id where 25 * m.dot * m.dot > 16 * na.s * m.sq)
select x.pair_id, contains(x.t, x.a) or h.pair_id is not null as found from x left join h on h.pair_id = x.pair_id""")
def verified_answers(spark, d):
    return qa(spark, d, "answer", "context").select("pair_id", answers.verified(F.col("answer"), F.col("context")).alias("found"))


@query(f"with {CHUNKS} select doc_id, chunk_ix, score from c where not isnan(score) and score > 0.6")
def dense_chunks(spark, d):
    return chunks(spark, d).where(filters.dense_enough(F.col("score"))).select("doc_id", "chunk_ix", "score")


# --- similarity -------------------------------------------------------------------------------------------------


def _cosine_sql(a: str, b: str, ids: str = "pair_id", rows: str = "qa", cos: str = "cos") -> str:
    """CTEs up to ``cos(ids, value)`` of the word counts of two columns."""
    def counts(name: str, column: str) -> str:
        return f"{cos}_{name} as (select {ids}, w, count(*) as n from (select {ids}, unnest(regexp_extract_all(lower(coalesce({column}, '')), '{WORD}')) as w from {rows}) group by {ids}, w)"

    def norm(name: str) -> str:
        return f"{cos}_n{name} as (select {ids}, sum(n * n) as s from {cos}_{name} group by {ids})"

    dot = f"{cos}_dot as (select {ids}, sum(a.n * b.n) as s from {cos}_a a join {cos}_b b using ({ids}, w) group by {ids})"
    value = "coalesce(d.s / sqrt(cast(x.s as double) * y.s), 0)"
    return f"{counts('a', a)}, {counts('b', b)}, {norm('a')}, {norm('b')}, {dot}, {cos} as (select r.{ids}, {value} as value from {rows} r left join {cos}_dot d using ({ids}) left join {cos}_na x using ({ids}) left join {cos}_nb y using ({ids}))"


@query(f"with {QA}, {_cosine_sql('answer', 'context')} select pair_id, round(value, 6) as support from cos")
def answer_support(spark, d):
    return qa(spark, d, "answer", "context").select("pair_id", F.round(arrow.bow_cosine("answer", "context"), 6).alias("support"))


@query(f"with {QA}, {_cosine_sql('question', 'context')} select pair_id, round(value, 6) as relevance from cos where value >= 0.2")
def relevance_filter(spark, d):
    x = qa(spark, d, "question", "context").withColumn("v", arrow.bow_cosine("question", "context"))
    return x.where("v >= 0.2").select("pair_id", F.round("v", 6).alias("relevance"))


@query(f"with {QA}, q2 as (select pair_id, concat_ws(' ', question, answer) as qa_text, context from qa), {_cosine_sql('qa_text', 'context', rows='q2')} select pair_id, round(value, 6) as context_relevance from cos")
def context_relevance(spark, d):
    return qa(spark, d, "question", "answer", "context").select("pair_id", F.round(questions.context_relevance(F.col("question"), F.col("answer"), F.col("context")), 6).alias("context_relevance"))


@query(f"""with {QA}, {_cosine_sql('answer', 'context', cos='sa')}, {_cosine_sql('question', 'context', cos='sq')}
select qa.pair_id from qa join sa using (pair_id) join sq using (pair_id) where {n_words('question')} between 10 and 50 and {n_words('answer')} between 5 and 100 and sa.value >= greatest(0.3, 0.2) and sq.value >= 0.2
and not ({" or ".join(f"regexp_matches(coalesce(question, '') || ' ' || coalesce(answer, ''), '{p}')" for p in filters.CONTENT.values())})""")
def quality_filtered(spark, d):
    return filters.quality_filter(qa(spark, d, "question", "answer", "context"), Quality(answer_support=0.3, relevance=0.2)).select("pair_id")


_COHERENCE = f"""with {CHUNKS}, t as (select doc_id, chunk_ix, w, count(*) as n from (select doc_id, chunk_ix, unnest(regexp_extract_all(lower(coalesce(content, '')), '{WORD}')) as w from c) group by all),
s as (select doc_id, chunk_ix, sum(n * n) as s from t group by all), p as (select a.doc_id, a.chunk_ix, b.chunk_ix as other, sum(a.n * b.n) as dot from t a join t b on a.doc_id = b.doc_id and a.w = b.w and a.chunk_ix <> b.chunk_ix group by all),
q as (select x.doc_id, x.chunk_ix, coalesce(p.dot / sqrt(cast(sx.s as double) * sy.s), 0) as v from c x join c y on x.doc_id = y.doc_id and x.chunk_ix <> y.chunk_ix left join p on p.doc_id = x.doc_id and p.chunk_ix = x.chunk_ix and p.other = y.chunk_ix left join s sx on sx.doc_id = x.doc_id and sx.chunk_ix = x.chunk_ix left join s sy on sy.doc_id = y.doc_id and sy.chunk_ix = y.chunk_ix),
r as (select *, row_number() over (partition by doc_id, chunk_ix order by v desc) as k from q),
h as (select c.doc_id, c.chunk_ix, c.score, coalesce(avg(r.v), 0) as coherence from c left join r on r.doc_id = c.doc_id and r.chunk_ix = c.chunk_ix and k <= 3 group by c.doc_id, c.chunk_ix, c.score)"""


@query(_COHERENCE + " select doc_id, chunk_ix, round(coherence, 6) as coherence from h")
def chunk_coherence(spark, d):
    return similarity.coherence(chunks(spark, d)).select("doc_id", "chunk_ix", F.round("coherence", 6).alias("coherence"))


@query(_COHERENCE + " select doc_id, chunk_ix, round(0.6::double * case when score is null or isnan(score) then 0.5 else greatest(0.0, least(1.0, score)) end + 0.4::double * coherence, 6) as relevance from h")
def chunk_relevance(spark, d):
    return similarity.chunk_scores(chunks(spark, d)).select("doc_id", "chunk_ix", F.round("relevance", 6).alias("relevance"))


def _dense_sql(threshold: float) -> str:
    return f"""with recursive e as (select label, vec_id, row_number() over (partition by label order by vec_id) as i, list_transform(embedding, lambda x: cast(x as double)) as v from embeddings),
p as (select a.label, a.i, b.i as j from e a join e b on a.label = b.label and a.i <> b.i where list_dot_product(a.v, b.v) / sqrt(list_dot_product(a.v, a.v) * list_dot_product(b.v, b.v)) > {threshold}),
n as (select e.label, e.vec_id, e.i, coalesce(list(p.j) filter (p.j is not null), []) as nb from e left join p on e.label = p.label and e.i = p.i group by e.label, e.vec_id, e.i)"""


@query(_dense_sql(0.3) + """, f(label, i, kept) as (select distinct label, 0::bigint, []::bigint[] from n union all select n.label, n.i, case when len(list_intersect(f.kept, n.nb)) > 0 then f.kept else list_append(f.kept, n.i) end from f join n on n.label = f.label and n.i = f.i + 1)
select n.label, n.vec_id, list_contains(f.kept, n.i) as kept from n join f on f.label = n.label and f.i = n.i""")
def dedup_greedy(spark, d):
    return similarity.near_dup_flags(table(tune(spark), d, "embeddings", "label", "vec_id", "embedding"), "label", "vec_id", "embedding", 0.3)


@query(_dense_sql(0.3) + """, f(label, i, kept) as (select distinct label, 0::bigint, 0::bigint from n union all select n.label, n.i, case when len(list_filter(n.nb, lambda j: j <= least(n.i - 1, f.kept))) > 0 then f.kept else f.kept + 1 end from f join n on n.label = f.label and n.i = f.i + 1),
g as (select label, i, kept, lag(kept, 1, 0) over (partition by label order by i) as before from f) select n.label, n.vec_id, g.kept > g.before as kept from n join g on g.label = n.label and g.i = n.i""")
def dedup_reference(spark, d):
    return similarity.near_dup_flags(table(tune(spark), d, "embeddings", "label", "vec_id", "embedding"), "label", "vec_id", "embedding", 0.3, "reference")


@query(_dense_sql(0.25) + """, f(label, i, taken, head) as (select distinct label, 0::bigint, []::bigint[], []::bigint[] from n
union all select n.label, n.i, case when list_contains(f.taken, n.i) then f.taken else list_concat(list_append(f.taken, n.i), list_filter(n.nb, lambda j: j > n.i and not list_contains(f.taken, j))) end, case when list_contains(f.taken, n.i) then [] else list_concat([n.i], list_filter(n.nb, lambda j: j > n.i and not list_contains(f.taken, j))) end from f join n on n.label = f.label and n.i = f.i + 1),
m as (select label, i as h, unnest(head) as j from f) select a.label, a.vec_id, b.vec_id as head from m join n a on a.label = m.label and a.i = m.j join n b on b.label = m.label and b.i = m.h""")
def merged_heads(spark, d):
    return similarity.merge_heads(table(tune(spark), d, "embeddings", "label", "vec_id", "embedding"), "label", "vec_id", "embedding", 0.25)


@query(f"""with recursive {CHUNKS}, {_text_near_sql("c", "doc_id", "chunk_ix", "content", 0.8)},
f(grp, i, taken, head) as (select distinct grp, 0::bigint, []::bigint[], []::bigint[] from n
union all select n.grp, n.i, case when list_contains(f.taken, n.i) then f.taken else list_concat(list_append(f.taken, n.i), list_filter(n.nb, lambda j: j > n.i and not list_contains(f.taken, j))) end, case when list_contains(f.taken, n.i) then [] else list_concat([n.i], list_filter(n.nb, lambda j: j > n.i and not list_contains(f.taken, j))) end from f join n on n.grp = f.grp and n.i = f.i + 1),
m as (select grp, i as h, unnest(head) as j from f)
select a.grp as doc_id, h.ord as chunk_ix, string_agg(a.text, chr(10) order by a.i) as content from m join i a on a.grp = m.grp and a.i = m.j join i h on h.grp = m.grp and h.i = m.h group by a.grp, h.ord""")
def merged_chunks(spark, d):
    return similarity.merge_chunks(chunks(spark, d))


@query(f"""with recursive {QA}, {_text_near_sql("qa", "conv_id", "pair_id", "question", 0.85)},
f(grp, i, kept) as (select distinct grp, 0::bigint, []::bigint[] from n union all select n.grp, n.i, case when len(list_intersect(f.kept, n.nb)) > 0 then f.kept else list_append(f.kept, n.i) end from f join n on n.grp = f.grp and n.i = f.i + 1)
select n.grp as conv_id, n.ord as pair_id, list_contains(f.kept, n.i) as kept from n join f on f.grp = n.grp and f.i = n.i""")
def dedup_questions(spark, d):
    return similarity.near_dup_flags(qa(spark, d, "conv_id", "question"), "conv_id", "pair_id", "question")


# --- joins, state -----------------------------------------------------------------------------------------------


@query(f"""with {QA}, {DOCS}, l as (select source, arg_max(content, loaded_at) as document from (select source, content, loaded_at from d order by doc_id) group by source)
select pair_id, document is not null as matched, length(document) as document_length from qa left join l on qa.source = l.source""")
def pairs_with_documents(spark, d):
    x = filters.with_documents(qa(spark, d, "source"), docs(spark, d, "source", "content", "loaded_at"))
    return x.select("pair_id", F.col("document").isNotNull().alias("matched"), F.length("document").cast("bigint").alias("document_length"))


_STATE = "s as (select path, max({'ts': ts, 'success': coalesce(success, false), 'error': coalesce(error, '')}) as m from processing_state group by path)"


@query(f"with {_STATE} select path, m.success as success, m.ts as ts, m.error as error from s")
def latest_state(spark, d):
    return state.latest_state(table(tune(spark), d, "processing_state"))


@query(f"with {_STATE}, {DOCS} select doc_id from d where source not in (select path from s where m.success)")
def unprocessed_files(spark, d):
    return state.unprocessed(docs(spark, d, "source"), table(spark, d, "processing_state")).select("doc_id")


@query(f"""with {_STATE}, {DOCS}, f as (select source, min(lower(format)) as format from d group by source)
select format, count(*) as total, count(*) filter (m.success) as successful, count(*) filter (m.success is not null and not m.success) as failed from f left join s on s.path = f.source group by format""")
def processing_stats(spark, d):
    return state.processing_stats(docs(spark, d, "source", "format"), table(spark, d, "processing_state"))


_MODEL = "case when pair_id % 2 = 0 then 'large' else 'small' end"


@query(f"with {QA} select {_MODEL} as model, 'judge' as task, count(*) as calls, cast(sum(floor(length(question) / 4)) as bigint) as input_tokens, cast(sum(floor(length(answer) / 4)) as bigint) as output_tokens, count(*) filter (coalesce(answer, '') = '') as failed from qa group by 1")
def usage_by_model(spark, d):
    x = qa(spark, d, "question", "answer")
    u = x.select(F.when(F.col("pair_id") % 2 == 0, "large").otherwise("small").alias("model"), F.lit("judge").alias("task"), fn.token_estimate(F.col("question")).alias("input_tokens"), fn.token_estimate(F.col("answer")).alias("output_tokens"), (F.coalesce("answer", F.lit("")) != "").alias("success"))
    return state.usage_summary(u)


# --- metrics ----------------------------------------------------------------------------------------------------


def _words_sql(c: str) -> str:
    return f"regexp_extract_all(lower(coalesce({c}, '')), '{WORD}')"


@query(f"""with {QA}, x as (select pair_id, answer, context, list_distinct({_words_sql('answer')}) as a, list_distinct({_words_sql('context')}) as c from qa)
select pair_id, round(case when len(a) = 0 or coalesce(length(context), 0) = 0 then 0 else 0.7::double * len(list_intersect(a, c)) / greatest(len(a), 1) + 0.3::double * least(1.0, length(answer) / greatest(length(context), 1)) end, 6) as relevance from x""")
def answer_relevance(spark, d):
    return qa(spark, d, "answer", "context").select("pair_id", F.round(metrics.relevance(F.col("answer"), F.col("context")), 6).alias("relevance"))


@query(f"""with {QA}, x as (select pair_id, coalesce(question, '') as q, len(regexp_extract_all(coalesce(question, ''), '{metrics.TOKEN}')) as n from qa)
select pair_id, round(case when n < 5 then 0.7 when n > 25 then 0.8 else 1.0 end::double * case when regexp_matches(lower(q), '^(?:{"|".join(metrics.WH)})') then 1.0 else 0.9 end::double * case when ends_with(rtrim(q), '?') then 1.0 else 0.8 end::double, 6) as quality from x""")
def question_quality(spark, d):
    return qa(spark, d, "question").select("pair_id", F.round(metrics.question_quality(F.col("question")), 6).alias("quality"))


def _grams(c: str, n: int) -> str:
    return f"list_distinct(list_transform(range(1, greatest(len({c}) - {n - 2}, 1)), lambda i: array_to_string({c}[i : i + {n - 1}], ' ')))"


def _jaccard(a: str, b: str) -> str:
    return f"case when len({a}) = 0 or len({b}) = 0 then 0 else len(list_intersect({a}, {b})) / (len({a}) + len({b}) - len(list_intersect({a}, {b}))) end"


@query(f"""with {QA}, x as (select pair_id, {_words_sql('answer')} as a, {_words_sql('context')} as c from qa), g as (select pair_id, {_grams('a', 2)} as a2, {_grams('c', 2)} as c2, {_grams('a', 3)} as a3, {_grams('c', 3)} as c3 from x)
select pair_id, round(0.4::double * {_jaccard('a2', 'c2')} + 0.6::double * {_jaccard('a3', 'c3')}, 6) as overlap from g""")
def answer_overlap(spark, d):
    return qa(spark, d, "answer", "context").select("pair_id", F.round(metrics.ngram_overlap(F.col("answer"), F.col("context")), 6).alias("overlap"))


@query(f"""with {QA}, t as (select conv_id, pair_id, {_words_sql('question')} as w from qa), u as (select conv_id, unnest(w) as x from t), l as (select conv_id, count(distinct x) / count(x) as lexical from u group by conv_id),
g as (select conv_id, pair_id, {_grams('w', 2)} as g2, {_grams('w', 3)} as g3 from t),
o as (select a.conv_id, avg(0.4::double * {_jaccard('a.g2', 'b.g2')} + 0.6::double * {_jaccard('a.g3', 'b.g3')}) as overlap from g a join g b on a.conv_id = b.conv_id and a.pair_id < b.pair_id group by a.conv_id),
n as (select conv_id, count(*) as n from t group by conv_id)
select n.conv_id, round(case when n < 2 then coalesce(lexical, 0) else 0.5 * coalesce(lexical, 0) + 0.5 * (1 - coalesce(overlap, 0)) end, 6) as diversity from n left join l using (conv_id) left join o using (conv_id)""")
def question_diversity(spark, d):
    return metrics.diversity(qa(spark, d, "conv_id", "question"), "conv_id", "pair_id", "question").select("conv_id", F.round("diversity", 6).alias("diversity"))


def _diversity_sql(column: str, name: str) -> str:
    """CTEs up to ``name(conv_id, diversity)``."""
    p = name
    return f"""{p}_t as (select conv_id, pair_id, {_words_sql(column)} as w from qa), {p}_l as (select conv_id, count(distinct x) / count(x) as lexical from (select conv_id, unnest(w) as x from {p}_t) group by conv_id),
{p}_g as (select conv_id, pair_id, {_grams('w', 2)} as g2, {_grams('w', 3)} as g3 from {p}_t),
{p}_o as (select a.conv_id, avg(0.4::double * {_jaccard('a.g2', 'b.g2')} + 0.6::double * {_jaccard('a.g3', 'b.g3')}) as overlap from {p}_g a join {p}_g b on a.conv_id = b.conv_id and a.pair_id < b.pair_id group by a.conv_id),
{p}_n as (select conv_id, count(*) as n from {p}_t group by conv_id),
{p} as (select n.conv_id, case when n < 2 then coalesce(lexical, 0) else 0.5 * coalesce(lexical, 0) + 0.5 * (1 - coalesce(overlap, 0)) end as diversity from {p}_n n left join {p}_l using (conv_id) left join {p}_o using (conv_id))"""


@query(f"""with {QA}, {_diversity_sql('question', 'dq')}, {_diversity_sql('answer', 'da')}
select conv_id, round(dq.diversity, 6) as question_diversity, round(da.diversity, 6) as answer_diversity, round((dq.diversity + da.diversity) / 2, 6) as overall_diversity from dq join da using (conv_id)""")
def pair_diversity(spark, d):
    x = metrics.pair_diversity(qa(spark, d, "conv_id", "question", "answer"), "conv_id", "pair_id")
    return x.select("conv_id", *[F.round(c, 6).alias(c) for c in ("question_diversity", "answer_diversity", "overall_diversity")])


def _counted_grams(name: str, column: str) -> str:
    parts = " union all ".join(f"select pair_id, {n} as k, unnest(list_transform(range(1, greatest(len({column}) - {n - 2}, 1)), lambda i: array_to_string({column}[i : i + {n - 1}], ' '))) as g from w" for n in range(1, 5))
    return f"{name} as (select pair_id, k, g, count(*) as n from ({parts}) group by all)"


@query(f"""with {QA}, w as (select pair_id, {_words_sql('answer')} as a, {_words_sql('context')} as c from qa), {_counted_grams('ga', 'a')}, {_counted_grams('gc', 'c')},
m as (select ga.pair_id, ga.k, sum(least(ga.n, gc.n)) as hit from ga join gc using (pair_id, k, g) group by all), ks as (select unnest([1, 2, 3, 4]) as k),
p as (select w.pair_id, len(a) as la, len(c) as lc, sum(ln(case when coalesce(hit, 0) = 0 then 0.1::double else hit end / greatest(1, len(a) - ks.k + 1))) as l, max(case when ks.k = 1 then coalesce(hit, 0) end) as first from w, ks left join m on m.pair_id = w.pair_id and m.k = ks.k group by all)
select pair_id, round(case when la = 0 or lc = 0 or first = 0 then 0 else case when la > lc then 1.0 else exp(1 - lc / la::double) end * exp(l / 4) end, 6) as bleu from p""")
def bleu_scores(spark, d):
    x = qa(spark, d, "answer", "context").withColumn("m", arrow.overlap_metrics("answer", "context"))
    return x.select("pair_id", F.round("m.bleu", 6).alias("bleu"))


def _hashed_sql(name: str, column: str) -> str:
    h = "md5(w)"
    digit = lambda i: f"(strpos('0123456789abcdef', substr({h}, {i}, 1)) - 1)"
    place = " + ".join(f"{digit(i)} * {16 ** (7 - i)}" for i in range(1, 8))
    return f"{name} as (select pair_id, ({place}) % 64 as b, sum(case when {digit(8)} % 2 = 0 then 1 else -1 end) as v from (select pair_id, unnest({_words_sql(column)}) as w from qa) group by all)"


@query(f"""with {QA}, {_hashed_sql('ha', 'question')}, {_hashed_sql('hb', 'answer')}, na as (select pair_id, sum(v * v) as s from ha group by pair_id), nb as (select pair_id, sum(v * v) as s from hb group by pair_id),
dd as (select pair_id, sum(ha.v * hb.v) as s from ha join hb using (pair_id, b) group by pair_id)
select qa.pair_id, round(coalesce(dd.s / nullif(sqrt(na.s::double * nb.s), 0), 0), 6) as similarity from qa left join dd using (pair_id) left join na using (pair_id) left join nb using (pair_id)""")
def hashed_similarity(spark, d):
    x = embed.embedded(embed.embedded(qa(spark, d, "question", "answer"), "question", into="vq"), "answer", into="va")
    return x.select("pair_id", F.round(embed.cosine(F.col("vq"), F.col("va")), 6).alias("similarity"))


@query()
def pair_metrics(spark, d):
    x = metrics.pair_metrics(qa(spark, d, "question", "answer", "context"))
    return x.select("pair_id", *[F.round(c, 6).alias(c) for c in ("bleu", "meteor", "rouge1", "rouge2", "rougeL", "relevance", "question_quality", "overall_quality")])


@query(f"""with {QA}, g as (select pair_id, unnest(list_transform(range(1, greatest(len(w) - 1, 1)), lambda i: array_to_string(w[i : i + 2], ' '))) as gram from (select pair_id, {_words_sql('question')} as w from qa))
select gram, count(*) as n, count(distinct pair_id) as pairs from g group by gram""")
def question_trigrams(spark, d):
    x = qa(spark, d, "question").select("pair_id", F.explode(fn.ngrams(fn.words(F.col("question")), 3)).alias("gram"))
    return x.groupBy("gram").agg(F.count("*").alias("n"), F.count_distinct("pair_id").alias("pairs"))


@query("""with x as (select doc_id, text, strpos(text, regexp_extract(text, '[A-Z]{2}-?[0-9]{3,5}')) as p, regexp_extract(text, '[A-Z]{2}-?[0-9]{3,5}') as code from documents where regexp_matches(text, '[A-Z]{2}-?[0-9]{3,5}'))
select doc_id, code, substr(text, greatest(0, p - 101) + 1, p - 1 + length(code) + 100 - greatest(0, p - 101)) as around from x""")
def code_contexts(spark, d):
    x = table(tune(spark), d, "documents", "doc_id", "text").withColumn("code", F.regexp_extract("text", "[A-Z]{2}-?[0-9]{3,5}", 0)).where("code <> ''")
    start = F.expr("position(code, text)") - 1
    return x.select("doc_id", "code", fn.around(F.col("text"), start, start + F.length("code")).alias("around"))


@query(f"""with {QA}, st as (select pair_id, answer, string_split(regexp_replace(coalesce(context, ''), '([.!?])[\\s\\x{{0B}}]+', '\\1' || chr(1), 'g'), chr(1)) as ss from qa),
se as (select pair_id, answer, unnest(list_filter(ss, lambda y: y <> '')) as s, generate_subscripts(list_filter(ss, lambda y: y <> ''), 1) as i from st), sr as (select pair_id * 100000 + i as sid, pair_id, i, answer, s from se), {_cosine_sql('answer', 's', ids='sid', rows='sr')},
best as (select sr.pair_id, s, row_number() over (partition by sr.pair_id order by round(value, 12) desc, i) as place from sr join cos using (sid))
select qa.pair_id, coalesce(best.s, 'this content') as sentence from qa left join best on best.pair_id = qa.pair_id and best.place = 1""")
def best_sentences(spark, d):
    return questions.best_sentence(qa(spark, d, "answer", "context"))


def _located_sql(rows: str, key: str, least: float = 0.6) -> str:
    """CTEs up to ``loc(key, main_text, ocr_text, image_caption)`` over ``rows(key, answer, content)``."""
    marked = "starts_with(para, '[OCR Text:') or starts_with(para, '[Image Caption:')"
    section = lambda name: f"regexp_extract(para, '\\[{name}: (.*?)\\]', 1)"
    return f"""lp as (select {key}, answer, unnest(string_split(coalesce(content, ''), chr(10) || chr(10))) as para, generate_subscripts(string_split(coalesce(content, ''), chr(10) || chr(10)), 1) as i from {rows}),
lm as (select {key}, any_value(answer) as answer, coalesce(string_agg(para, chr(10) || chr(10) order by i) filter (not ({marked})), '') as main from lp group by {key}),
ls as (select {key} * 100000 + i as sid, {key}, answer, starts_with(para, '[OCR') as ocr, case when starts_with(para, '[OCR') then {section('OCR Text')} else {section('Image Caption')} end as body from lp where {marked}),
{_cosine_sql('answer', 'main', ids=key, rows='lm', cos='cm')}, {_cosine_sql('answer', 'body', ids='sid', rows='ls', cos='cs')},
lb as (select {key}, max(value) filter (ocr) as o, max(value) filter (not ocr) as c from ls join cs using (sid) group by {key}),
loc as (select cm.{key}, cm.value >= {least} as main_text, coalesce(o, 0) >= {least} as ocr_text, coalesce(c, 0) >= {least} as image_caption from cm left join lb using ({key}))"""


@query(f"""with {DOCS}, x as (select doc_id, content, regexp_extract(content, '\\[Image Caption: ([^\\]]*)\\]', 1) as answer from d), y as (select * from x where answer <> ''), {_located_sql('y', 'doc_id')} select * from loc""")
def located_answers(spark, d):
    x = docs(spark, d, "content").withColumn("answer", F.regexp_extract("content", r"\[Image Caption: ([^\]]*)\]", 1)).where("answer <> ''")
    return answers.located(x).select("doc_id", "main_text", "ocr_text", "image_caption")


# --- layout, images, prompts ------------------------------------------------------------------------------------

# Spans made of all lines of each document: words as spans, their places by position, sizes by line.
_SPANS = f"""l as (select doc_id, unnest(string_split(content, chr(10))) as line_text, generate_subscripts(string_split(content, chr(10)), 1) as line from d where content is not null),
sp as (select doc_id, line, unnest(regexp_split_to_array(line_text, ' ')) as text, generate_subscripts(regexp_split_to_array(line_text, ' '), 1) as w, case when line = 1 then 15.0 else 11.0 end as size from l where line_text <> '')"""


def _spans(spark, d):
    x = docs(spark, d, "content").where("content is not null").select("doc_id", F.posexplode(F.split("content", "\n")).alias("p", "t")).where("t <> ''")
    w = x.select("doc_id", (F.col("p") + 1).alias("line"), F.posexplode(F.split("t", " ")).alias("w", "text"))
    return w.select("doc_id", "line", ((F.col("w") % 4) * 20.04).alias("x"), "text", F.when(F.col("line") == 1, 15.0).otherwise(11.0).alias("size"), F.lit(0).alias("flags"), F.col("w"))


@query(f"""with {DOCS}, {_SPANS} select doc_id, count(distinct (w - 1) % 4) > 2 as "table" from sp group by doc_id""")
def table_blocks(spark, d):
    from siltstone.functions import layout

    return layout.block_kinds(_spans(spark, d), ["doc_id"])


@query(f"""with {DOCS}, {_SPANS}, x as (select doc_id, line, size, string_agg(text, '' order by (w - 1) % 4, text) as t from sp group by doc_id, line, size)
select doc_id, line, case when size > 14 then '## ' || trim(t) || ' ##' when regexp_matches(ltrim(t), '^(?:[•●○▪◦\\-]|\\d+\\.)') then '• ' || trim(t) else t end as text from x""")
def laid_out_lines(spark, d):
    from siltstone.functions import layout

    return layout.line_texts(_spans(spark, d), ["doc_id"]).select("doc_id", F.col("line").cast("bigint").alias("line"), "text")


@query(f"""with {DOCS}, {_SPANS}, c as (select doc_id, line, (w - 1) % 4 as k, string_agg(text, '' order by text) as cell from sp group by all), n as (select doc_id, list_sort(list(distinct (w - 1) % 4)) as ks from sp group by doc_id),
r as (select doc_id, line, map_from_entries(list((k, cell))) as m from c group by doc_id, line), f as (select doc_id, line, list_transform(ks, lambda k: coalesce(m[k], '')) as cells from r join n using (doc_id))
select doc_id, cast(line as bigint) as row, '| ' || array_to_string(cells, ' | ') || ' |' as text from f where len(list_filter(cells, lambda x: trim(x) <> '')) > 0
union all select doc_id, -2, '|' || array_to_string(list_transform(ks, lambda k: '   '), '|') || '|' from n union all select doc_id, -1, '|' || array_to_string(list_transform(ks, lambda k: '---'), '|') || '|' from n""")
def table_markdown(spark, d):
    from siltstone.functions import layout

    return layout.table_lines(_spans(spark, d), ["doc_id"]).select("doc_id", F.col("row").cast("bigint").alias("row"), "text")


@query("""select vec_id, label * 40 >= 100 and vec_id % 300 >= 100 and embedding[1] >= 0.01 and label >= 5 and abs(embedding[2]) >= 0.01 as ok from embeddings""")
def image_filter(spark, d):
    e = table(tune(spark), d, "embeddings", "vec_id", "label", "embedding")
    return e.select("vec_id", filters.image_ok(F.col("label") * 40, F.col("vec_id") % 300, F.col("embedding")[0], F.col("label"), F.abs(F.col("embedding")[1])).alias("ok"))


@query(f"""with {CHUNKS}, x as (select doc_id, chunk_ix, substr(content, 1, 20) as o, case when chunk_ix % 2 = 0 then '' else 'chunk ' || chunk_ix end as cap, floor(coalesce(case when isnan(score) then 0 else score end, 0) * 100) / 100 as s from c)
select doc_id, chunk_ix, concat_ws(chr(10), case when o <> '' then '[OCR Text: ' || o || ']' end, case when cap <> '' then '[Image Caption: ' || cap || ']' end, '[Detected Objects: box (' || printf('%.2f', s) || '), lid (0.50)]', '[Visual Analysis: which? -> ' || chunk_ix || ']') as text from x""")
def combined_annotations(spark, d):
    x = chunks(spark, d)
    s = F.floor(F.coalesce(F.when(F.isnan("score"), 0.0).otherwise(F.col("score")), F.lit(0.0)) * 100) / 100
    objects = F.array(F.struct(F.lit("box").alias("label"), s.alias("confidence")), F.struct(F.lit("lid").alias("label"), F.lit(0.5).alias("confidence")))
    qa_ = F.array(F.struct(F.lit("which?").alias("question"), F.col("chunk_ix").cast("string").alias("answer")))
    a = F.struct(F.substring("content", 1, 20).alias("ocr_text"), F.when(F.col("chunk_ix") % 2 == 0, "").otherwise(F.concat(F.lit("chunk "), F.col("chunk_ix").cast("string"))).alias("caption"), F.struct(objects.alias("objects"), F.lit("").alias("scene_description"), qa_.alias("visual_qa")).alias("context"))
    return x.select("doc_id", "chunk_ix", markers.combine_annotations(F.array(a)).alias("text"))


@query(f"""with {QA}, x as (select pair_id, trim(lower(coalesce(question, ''))) as q, coalesce(case when isnan(validation_scores['question_quality']) then 0 else validation_scores['question_quality'] end, 0) as s from qa),
k as (select *, case when regexp_matches(q, '^(?:who|whose|whom|wer|qui|quién)(?:[^\\p{{L}}]|$)') then 'HUMAN' when regexp_matches(q, '^(?:where|wo|où|dónde)(?:[^\\p{{L}}]|$)') then 'LOCATION' when regexp_matches(q, '^(?:when|how many|how much|wann|wie oft|combien|quand|cuándo|cuántas)(?:[^\\p{{L}}]|$)') then 'NUMERIC' when regexp_matches(q, '^(?:why|how|describe|explain|warum|beschreibe|pourquoi|cómo)(?:[^\\p{{L}}]|$)') then 'DESCRIPTION' else 'ENTITY' end as class from x)
select pair_id, class, round(s * case class when 'DESCRIPTION' then 1.2 when 'ENTITY' then 1.1 when 'NUMERIC' then 0.9 else 1.0 end::double, 6) as rank, round(least(1.0, (s * 1.1::double + 0.5) / 2), 6) as confidence from k""")
def question_ranks(spark, d):
    x = qa(spark, d, "question", "validation_scores")
    v = F.try_element_at("validation_scores", F.lit("question_quality"))
    s = F.coalesce(F.when(F.isnan(v), 0.0).otherwise(v), F.lit(0.0))
    cls = questions.question_class(F.coalesce("question", F.lit("")))
    return x.select("pair_id", cls.alias("class"), F.round(questions.question_rank(s, cls, F.lit("text")), 6).alias("rank"), F.round(questions.confidence(s, F.lit(True), F.lit(0.5)), 6).alias("confidence"))


@query(f"""with {QA} select pair_id, 'Say the same in other words, on lines that begin with Q: and A:.' || chr(10) || 'Q: ' || coalesce(question, '') || chr(10) || 'A: ' || coalesce(answer, '') || chr(10) || 'Text: ' || coalesce(context, '') as prompt from qa""")
def variation_prompts(spark, d):
    from siltstone.models.prompts import Prompts

    x = qa(spark, d, "question", "answer", "context")
    return x.select("pair_id", Prompts().column("variation", question=F.col("question"), answer=F.col("answer"), text=F.col("context")).alias("prompt"))


@query(f"""with {QA}, {DOCS}, dl as (select source, doc_id, content from d where source is not null qualify row_number() over (partition by source order by loaded_at desc, doc_id desc) = 1),
sp as (select source, unnest(string_split(coalesce(content, ''), chr(10) || chr(10))) as p, generate_subscripts(string_split(coalesce(content, ''), chr(10) || chr(10)), 1) as i from dl),
sx as (select source, i * 3 as o, p as t from sp where not (starts_with(p, '[OCR Text:') or starts_with(p, '[Image Caption:'))
union all select source, i * 3 + 1, regexp_extract(p, '\\[OCR Text: (.*?)\\]', 1) from sp where regexp_matches(p, '\\[OCR Text: (.*?)\\]')
union all select source, i * 3 + 2, regexp_extract(p, '\\[Image Caption: (.*?)\\]', 1) from sp where regexp_matches(p, '\\[Image Caption: (.*?)\\]')),
sa as (select source, string_agg(t, chr(10) || chr(10) order by o) as text from sx group by source),
pj as (select pair_id, answer, dl.content, sa.text from qa join dl on dl.source = qa.source left join sa on sa.source = qa.source where dl.content is not null), {_cosine_sql('answer', 'text', rows='pj', cos='ck')},
ok as (select pj.pair_id, answer, content from pj join ck using (pair_id) where ck.value >= 0.3), {_located_sql('ok', 'pair_id')} select * from loc""")
def source_validation(spark, d):
    x = metrics.validate_against_source(qa(spark, d, "answer", "source"), docs(spark, d, "source", "content", "loaded_at"), 0.3)
    return x.select("pair_id", "main_text", "ocr_text", "image_caption")


# --- pipeline ---------------------------------------------------------------------------------------------------

#: Thresholds of the pipeline for word-count cosines, which are lower than those of sentence encoders.
WORD_COUNTS = Config(quality=Quality(min_question_words=5, answer_support=0.25, relevance=0.05))


@query()
def pipeline_accepted(spark, d):
    return pipeline.run(docs(spark, d, "source", "content"), Template(), WORD_COUNTS)[0].select("doc_id", "seq", "question", "answer", "instruction")


@query()
def pipeline_failed(spark, d):
    return pipeline.run(docs(spark, d, "source", "content"), Template(), WORD_COUNTS)[1].select("doc_id", "seq", "question", "reason")
