"""The named queries of this package, each beside its SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import functions as F

from lastro.llm import (
    chat,
    fuzzy_lines,
    licences,
    mixing,
    negatives,
    page_text,
    quality_rules,
    secrets,
    simhash,
    spellings,
    substrings,
    templates,
    url_rules,
)
from lastro.llm.frames import table
from lastro.plans.registry import Section

section = Section()

OP1_SQL = r"""
with rows as (select doc_id, coalesce(text, '') as text, row_number() over () as r from documents),
words as (select r, unnest(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) as word,
                 unnest(range(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')))) as i from rows),
lines as (select r, count(*) as n_lines, count(*) - count(distinct line) as n_dup_lines
          from (select r, unnest(string_split(text, chr(10))) as line from rows)
          where regexp_matches(line, '[^\x20\x09-\x0D]') group by r),
windows as (select r, i, word as a, lead(word) over (partition by r order by i) as b,
                   lead(word, 2) over (partition by r order by i) as c from words),
counted as (select r, i, count(*) over (partition by r, a, b, c) as n from windows where c is not null),
covered as (select r, count(distinct i + d) as n_repeat_words
            from counted, (select unnest([0, 1, 2]) as d) where n > 1 group by r),
totals as (select r, count(*) as n_words, sum(length(word)) as word_chars,
                  count(*) filter (where regexp_matches(word, '[A-Za-z]|[^\x00-\x7F]')) as n_letter_words
           from words group by r),
measured as (
  select doc_id, coalesce(n_words, 0) as n_words, coalesce(word_chars, 0)::bigint as word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as n_symbols,
         coalesce(n_lines, 0) as n_lines, coalesce(n_dup_lines, 0) as n_dup_lines,
         coalesce(n_repeat_words, 0) as n_repeat_words, coalesce(n_letter_words, 0) as n_letter_words
  from rows left join totals using (r) left join lines using (r) left join covered using (r)),
bits as (
  select *, (case when n_words < 50 then 1 else 0 end) + (case when 100 * n_repeat_words > 50 * n_words then 2 else 0 end)
         + (case when 10 * n_symbols > n_words then 4 else 0 end)
         + (case when 100 * n_dup_lines > 40 * n_lines then 8 else 0 end)
         + (case when word_chars < 3 * n_words then 16 else 0 end)
         + (case when word_chars > 10 * n_words then 32 else 0 end)
         + (case when 100 * n_letter_words < 70 * n_words then 64 else 0 end) as fail_bits
  from measured)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (fail_bits & 3) <> 0 as base_failed,
       fail_bits = 0 as kept, n_lines, n_letter_words, fail_bits::bigint as fail_bits
from bits
"""


@section.query("op1_quality_rules", OP1_SQL)
def op1_quality_rules(spark, sf_dir):
    """Measurements, failure bits and both verdicts of every document."""
    return quality_rules.report(table(spark, sf_dir, "documents"))


def _runs(name: str, pattern: str, kind: str, rank: int, keep: str = "true") -> str:
    """Leftmost matches of a pattern with their places, as SQL."""
    return rf"""
{name}_found as (select r, text, regexp_extract_all(text, $re${pattern}$re$) as hits,
                        regexp_split_to_array(text, $re${pattern}$re$) as gaps from rows),
{name}_each as (select r, unnest(hits) as value, unnest(range(len(hits))) as i, hits, gaps from {name}_found),
{name} as (select r, '{kind}' as kind, {rank} as rank, value,
                  (list_sum(list_transform(gaps[1:i + 1], lambda x: length(x)))
                   + coalesce(list_sum(list_transform(hits[1:i], lambda x: length(x))), 0))::bigint as "start"
           from {name}_each where {keep})"""


def _entropy(name: str, shape: secrets.CharacterClass, rank: int, taken: str) -> str:
    """Runs without the taken characters, their pieces without harmless parts, and those whose best window passes."""
    value = "lower(value)" if shape.fold else "value"
    keep = " and ".join(f"regexp_matches(value, '{need}')" for need in shape.needs)
    harmless = "|".join(f"(?:{pattern})" for pattern in secrets.ALLOWED)
    return (
        _runs(f"{name}_all", f"[{shape.characters}]{{{shape.least},}}", shape.kind, rank)
        + rf""",
{name}_runs as (select *, row_number() over () as run from {name}_all),
{name}_chars as (select r, run, "start" + i as at_, value[i + 1] as c from
                 (select *, unnest(range(length(value))) as i from {name}_runs)),
{name}_free as (select *, at_ - row_number() over (partition by run order by at_) as island from {name}_chars h
                where not exists (select 1 from {taken} b where b.r = h.r and b.start <= at_ and at_ < b.start + length(b.value))),
{name}_pieces as (select r, min(at_) as begins, string_agg(c, '' order by at_) as whole from {name}_free
                  group by r, run, island having count(*) >= {shape.least}),
{name}_split as (select *, regexp_extract_all(whole, $re${harmless}$re$) as hits, regexp_split_to_array(whole, $re${harmless}$re$) as gaps
                 from {name}_pieces),
{name}_parts as (select r, begins, hits, gaps, unnest(gaps) as value, unnest(range(len(gaps))) as i from {name}_split),
{name}_long as (
  select r, '{shape.kind}' as kind, {rank} as rank, value,
         (begins + coalesce(list_sum(list_transform(gaps[1:i], lambda x: length(x))), 0)
          + coalesce(list_sum(list_transform(hits[1:i], lambda x: length(x))), 0))::bigint as "start"
  from {name}_parts where length(value) >= {shape.least} and {keep}),
{name}_windows as (select distinct value, substr({value}, w::bigint, {shape.window}) as part
                   from (select value, unnest(range(1, length(value) - {shape.window} + 2)) as w from {name}_long)),
{name}_sums as (select value, part, sum(round(n * log2(n) * 1000000)::bigint) as gained
                from (select value, part, c, count(*) as n
                      from (select value, part, unnest(string_split(part, '')) as c from {name}_windows)
                      group by all) group by all),
{name} as (select * from {name}_long where value in
           (select value from {name}_sums group by value having min(gained) <= {secrets.least_gain(shape)}))"""
    )


OP2_SQL = rf"""
with rows as (select doc_id, coalesce(text, '') as text, row_number() over () as r from documents),
{_runs("assign", secrets.ASSIGN, "assign", 0, "length(regexp_extract(value, $re$" + secrets.ASSIGN + "$re$, 2)) >= 6")},
{_runs("access", secrets.ACCESS, "access", 1)},
{_runs("hex", secrets.HEX, "hex", 2)},
base as (select * from assign union all select * from access union all select * from hex),
{_entropy("ehex", secrets.HEX_CLASS, 3, "base")},
taken as (select * from base union all select * from ehex),
{_entropy("ebase", secrets.BASE64_CLASS, 4, "taken")},
found as (select *, true as base from base union all select *, false from ehex union all select *, false from ebase),
spelled as (select *, kind || ':' || "start" || ':' || ("start" + length(value)) as span from found),
totals as (
  select r, count(*) filter (where kind = 'assign') as n_assign, count(*) filter (where kind = 'access') as n_access,
         count(*) filter (where kind = 'hex') as n_hex, count(*) filter (where not base) as n_added,
         string_agg(span, ',' order by "start", rank) filter (where base) as base_spans,
         string_agg(span, ',' order by "start", rank) as spans from spelled group by r)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
       sha256(coalesce(base_spans, '')) as base_sha256, coalesce(spans, '') as spans, coalesce(n_added, 0) as n_added
from rows left join totals using (r)
"""


@section.query("op2_secret_scan", OP2_SQL)
def op2_secret_scan(spark, sf_dir):
    """Secrets in every document: fixed patterns and high-entropy candidates."""
    return secrets.report(table(spark, sf_dir, "documents"))


@section.query("op3_simhash_covering")
def op3_simhash_covering(spark, sf_dir):
    """Fingerprint and near-duplicate component of every document."""
    return simhash.cluster(table(spark, sf_dir, "documents"))


@section.query("op4_template_leaks")
def op4_template_leaks(spark, sf_dir):
    """Documents that hold a benchmark passage, also with other numbers or names."""
    return templates.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP5_SQL = r"""
with docs as (
  select doc_id, source, row_number() over () as r,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
         md5(coalesce(doc_id::varchar, '')) as digest from documents),
sources as (
  select source, sum(size)::bigint as source_size,
         row_number() over (order by source nulls last) - 1 as place from docs group by source),
weighed as (select *, [5, 2, 1][(place % 3 + 1)::int] as weight, 3 * source_size as most from sources),
filled as (
  select *, sum(source_size) over ()
            - coalesce(sum(most) over (order by most / weight, place rows between unbounded preceding and 1 preceding), 0)
            as left_words,
         sum(weight) over (order by most / weight, place rows between current row and unbounded following) as rest_weight
  from weighed),
shared as (
  select *, most * rest_weight >= weight * left_words as open,
         max(case when most * rest_weight >= weight * left_words then left_words::double / rest_weight::double end) over ()
           as share from filled),
targets as (select source, place, source_size, case when open then weight * share else most::double end as target from shared),
placed as (
  select doc_id, size, source_size, target, place,
         coalesce(sum(size) over (partition by place order by digest, doc_id, size
                                  rows between unbounded preceding and 1 preceding), 0)::bigint as before,
         case when source_size > 0 then floor(target / source_size)::bigint else 0 end as whole
  from docs join targets on docs.source is not distinct from targets.source),
taken as (
  select *, size * whole + greatest(0, least(size, round(target - whole * source_size)::bigint - before)) as taken,
         before / target as share from placed)
select doc_id, size, source_size, target, taken::bigint as taken,
       case when taken > 0 then case place % 3
         when 0 then 2.0 * share / (1.5 + sqrt(2.25 - 2.0 * share))
         when 1 then share
         else case when share * 0.8125 < 0.1875 then
                2.0 * (share * 0.8125) / (0.25 + sqrt(0.0625 + 1.0 * (share * 0.8125)))
              else 0.5 + 2.0 * (share * 0.8125 - 0.1875) / (0.5 + sqrt(0.25 + 6.0 * (share * 0.8125 - 0.1875))) end
         end end as position
from taken
"""


@section.query("op5_curriculum_mix", OP5_SQL)
def op5_curriculum_mix(spark, sf_dir):
    """What the mix takes of every document, and when it first comes up."""
    return mixing.mix(table(spark, sf_dir, "documents"))


OP6_SQL = r"""
with split as (
  select page_id, translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) as path,
         row_number() over () as r from pages),
rules(action, rule_host, rule_path) as (values ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
  ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
best as (select r, arg_max(rule_host || rule_path, length(rule_host || rule_path)) as rule,
                arg_max(action, length(rule_host || rule_path)) as action
         from split, rules
         where (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path) group by r)
select page_id, host, path, rule, coalesce(action, 'allow') as verdict from split left join best using (r)
"""


@section.query("op6_url_rules", OP6_SQL)
def op6_url_rules(spark, sf_dir):
    """The verdict of the longest fitting rule on every page's url."""
    return url_rules.judge(table(spark, sf_dir, "pages"), url_rules.literal_rules(spark))


@section.query("op7_page_text")
def op7_page_text(spark, sf_dir):
    """Main text of every page."""
    return page_text.extract(table(spark, sf_dir, "pages"))


OP8_SQL = r"""
with docs as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words, row_number() over () as r
  from documents),
tokens as (select r, coalesce(doc_id, -9223372036854775807) as d, unnest(words) as word, unnest(range(len(words))) as i from docs),
windows as (select r, d, i, string_agg(word, ' ') over twenty as w, count(*) over twenty as n from tokens
            window twenty as (partition by r order by i rows between current row and 19 following)),
firsts as (select w, min((d, i)) as first from windows where n = 20 group by w),
later as (select r, i from windows join firsts using (w) where n = 20 and (d, i) > first),
gone as (select distinct r, i + k as i, true as gone from later, (select unnest(range(20)) as k)),
kept as (select r, count(*) as n_words, count(gone) as n_removed, string_agg(word, ' ' order by i) filter (where gone is null) as kept
         from tokens left join gone using (r, i) group by r)
select doc_id, coalesce(n_words, 0) as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from docs left join kept using (r)
"""


@section.query("op8_substring_dedup", OP8_SQL)
def op8_substring_dedup(spark, sf_dir):
    """Every document's words without those of windows that start earlier."""
    out = substrings.remove(table(spark, sf_dir, "documents"), texts=False)
    return out.drop("kept")


def _escaped(text: str) -> str:
    for plain, coded in chat.ESCAPES:
        text = f"replace({text}, '{plain}', '{coded}')"
    return text


OP9_SQL = rf"""
with talks as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]' union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
turns as (select *, length('<s>[' || {_escaped("role")} || '] ' || {_escaped("text")} || ' </s>') as chars,
                 row_number() over (partition by conv_id order by turn nulls first, role, text) as n,
                 count(*) over (partition by conv_id) as of_all from talks),
prefixes as (select *, sum(chars) over (partition by conv_id order by n) as prefix from turns)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by n)) as turns_sha256,
       coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by n) filter (where role = 'assistant'), '')) as loss_sha256,
       (sum(prefix) filter (where role = 'assistant' or n = of_all))::bigint as formatted_chars
from prefixes group by conv_id
"""


@section.query("op9_chat_prefix", OP9_SQL)
def op9_chat_prefix(spark, sf_dir):
    """Every assistant turn as an example; what the examples hold, read back."""
    talks = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    planted = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"),
    )
    return chat.digest(chat.examples(talks.unionByName(planted)))


@section.query("op10_fuzzy_lines")
def op10_fuzzy_lines(spark, sf_dir):
    """Every document's lines that go because an equal or similar line comes earlier."""
    return fuzzy_lines.report(table(spark, sf_dir, "documents"))


def _quoted(values) -> str:
    return ", ".join(f"'{value}'" for value in values)


def _licence_sql() -> str:
    using = licences.Scan()
    texts = ", ".join(f"({n}, '{t.label}', '{' '.join(t.words)}')" for n, t in enumerate(using.templates))
    keys = ", ".join(f"({n}, '{phrase}')" for n, t in enumerate(using.templates) for phrase in t.phrases)
    named = " union all ".join(
        f"select r, spot, '{label}' as label from ahead where four[1:{len(phrase.split())}] = [{_quoted(phrase.split())}]"
        for phrase, label in using.phrases
    )
    return rf"""
with rows as (
  select doc_id, row_number() over () as r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from documents),
tokens as (select r, unnest(words) as word, unnest(range(len(words))) as spot from rows),
ahead as (select r, spot, [word, lead(word) over w, lead(word, 2) over w, lead(word, 3) over w] as four
          from tokens window w as (partition by r order by spot)),
named as ({named}),
base as (select r, count(*) as n_base, min(spot) as first_word, max(spot) as last_word from named group by r),
templates(template, label, text) as (values {texts}),
phrases(template, phrase) as (values {keys}),
places as (select template, unnest(string_split(text, ' ')) as word, unnest(range(len(string_split(text, ' ')))) as place
           from templates),
frequencies as (select word, count(distinct r) as df from (select distinct word from places) left join tokens using (word) group by word),
ranks as (select word, row_number() over (order by df, word) as rank from frequencies),
kept as (select template, word, rank, row_number() over (partition by template order by rank) as k
         from (select distinct template, word from places) join ranks using (word)),
postings as (select template, word, rank, place from places join kept using (template, word) where k <= {using.indexed}),
sizes as (select template, count(*) as size from postings group by template),
own as (select r, rank, row_number() over (partition by r order by rank) as k
        from (select distinct r, rank from tokens join (select distinct word, rank from postings) using (word))),
voted as (
  select r, template, spot - place as shift, count(*) as found, count(k) filter (where k <= {using.looked_up}) as votes
  from tokens join postings using (word) left join own using (r, rank) group by all),
padded as (select r, ' ' || array_to_string(words, ' ') || ' ' as padded from rows),
lacks as (select distinct r, template, true as lacks from padded, phrases where not contains(padded, ' ' || phrase || ' ')),
passed as (
  select r, template, label, max(found) / any_value(size) as score
  from voted join sizes using (template) join templates using (template) left join lacks using (r, template)
  where votes >= least(size, {using.votes}) and lacks is null group by r, template, label),
best as (select r, max(score) as score from passed group by r),
base_labels as (select r, string_agg(label, ',' order by label) as base_labels from (select distinct r, label from named) group by r),
labels as (select r, string_agg(label, ',' order by label) as labels
           from (select r, label from named union select r, label from passed) group by r)
select doc_id, len(words) as n_words, coalesce(n_base, 0) as n_base, first_word, last_word, coalesce(base_labels, '') as base_labels,
       coalesce(labels, '') as labels, coalesce(score, 0.0)::double as score
from rows left join base using (r) left join base_labels using (r) left join labels using (r) left join best using (r)
"""


@section.query("op11_licence_scan", _licence_sql())
def op11_licence_scan(spark, sf_dir):
    """Licence phrases and notices in every document."""
    return licences.scan(table(spark, sf_dir, "documents"))


@section.query("op12_spelling_groups")
def op12_spelling_groups(spark, sf_dir):
    """Every frequent word with the near word it is probably a spelling of."""
    return spellings.report(table(spark, sf_dir, "documents"))


OP13_SQL = """
with given as (
  select distinct vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)),
padded as (select vec_id, label, list_resize(v, (select max(len(v)) from given), 0.0) as v, row_number() over () as r from given),
pairs as (
  select a.r, a.vec_id as anchor_id, b.r as other, b.vec_id, a.label = b.label as same,
         list_inner_product(a.v, b.v)::bigint as score
  from padded a join padded b on a.r <> b.r where a.vec_id % 50 = 0),
positives as (
  select * from pairs where same qualify row_number() over (partition by r order by score desc, vec_id nulls last) <= 5),
met as (
  select p.anchor_id, p.vec_id as positive_id, n.vec_id as negative_id, p.score as positive_score, n.score as negative_score,
         row_number() over (partition by p.r, p.other order by n.score desc, n.vec_id nulls last) as rank
  from positives p join pairs n on n.r = p.r and not n.same
    and 50 * p.score <= 100 * n.score and 100 * n.score <= 95 * p.score)
select anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score from met where rank <= 3
"""


@section.query("op13_hard_negatives", OP13_SQL)
def op13_hard_negatives(spark, sf_dir):
    """Negatives inside the band below each positive of every anchor."""
    return negatives.report(table(spark, sf_dir, "embeddings"))
