"""The queries of the core over the test tables, each with the SQL that must give the same rows.

A query is (function, shape, SQL). The shape names the columns with their kinds (s string,
i bigint, d double, b boolean); both sides are cast to it.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import agenda, cleaning, dataset, intervals, inventory, people, providers, quality, resolve, sections, turns
from ..operators.pairing import best_assignment
from ..sources import files, sinks
from ..streaming import arrivals

KINDS = {"s": ("string", "VARCHAR"), "i": ("bigint", "BIGINT"), "d": ("double", "DOUBLE"), "b": ("boolean", "BOOLEAN")}
REGISTRY: dict[str, tuple[Callable, str, str | None]] = {}


def query(shape: str, sql: str | None = None):
    def add(f: Callable) -> Callable:
        cols = [c.split(":") for c in shape.split()]

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = f(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))
            return df.select(*[F.col(c).cast(KINDS[k][0]).alias(c) for c, k in cols])

        wrapped = None if sql is None else "select " + ", ".join(f'CAST("{c}" AS {KINDS[k][1]}) AS "{c}"' for c, k in cols) + f" from ({sql})"
        REGISTRY[f.__name__] = (run, shape, wrapped)
        return f

    return add


# ------------------------------------------------------------------ common inputs
def records(t) -> DataFrame:
    r = t("records").dropDuplicates(["rec_id"])
    last = lambda role: F.array_join(F.transform(F.filter("messages", lambda m: F.lower(m["role"]) == role), lambda m: F.coalesce(m["content"], F.lit(""))), "")
    return r.withColumn("user", last("user")).withColumn("answer", last("assistant")).withColumn("stem", F.col("meta.stem")).withColumn("top", F.col("meta.top")).withColumn("seq_tokens", F.col("meta.seq_tokens"))


def _role(role: str) -> str:
    return f"array_to_string(list_transform(list_filter(messages, lambda m: lower(m.role) = '{role}'), lambda m: coalesce(m.content, '')), '')"


REC = f"""(select distinct on (rec_id) rec_id, messages, split, author, source, meta.stem as stem, meta.top as top, meta.seq_tokens as seq_tokens,
 {_role("user")} as "user", {_role("assistant")} as answer, {_role("system")} as system from records)"""


def segments(t) -> DataFrame:
    s = t("segments").groupBy("stem", "pt", "ord")
    return s.agg(F.min("start_s").alias("start"), F.min("end_s").alias("end"), F.min("speaker").alias("speaker"), F.min("label").alias("label"), F.min("text").alias("text"))


SEG = "(select stem, pt, ord, min(start_s) as start, min(end_s) as \"end\", min(speaker) as speaker, min(label) as label, min(text) as text from segments group by all)"
SEG_KEYS = ["stem", "pt"]


def ledger(t) -> DataFrame:
    return t("ledger").select("stem", "committee", "wp", "sitting", "raw_dir", "pdf_src", "audio_src", "state", "first_seen", "last_seen").distinct()


LED = "(select distinct stem, committee, wp, sitting, raw_dir, pdf_src, audio_src, state, first_seen, last_seen from ledger)"


def drop_files(t) -> DataFrame:
    led = t("ledger")
    a = led.select("stem", F.explode("audio_src").alias("path")).union(led.where("pdf_src is not null").select("stem", "pdf_src"))
    return a.distinct().withColumn("length", F.length("path"))


FILES = "(select distinct stem, path, length(path) as length from (select stem, unnest(audio_src) as path from ledger union all select stem, pdf_src from ledger where pdf_src is not null))"
_DROP = inventory.DROP_NAME.replace("'", "''")
PARTS = f"""(select stem, path, length, n, nullif(regexp_extract(n, '{_DROP}', 1), '')::int as sitting, upper(nullif(regexp_extract(n, '{_DROP}', 2), '')) as abbr,
 case when n <> '' and regexp_matches(n, '{_DROP}') then regexp_extract(n, '{_DROP}', 5) || '-' || regexp_extract(n, '{_DROP}', 4) || '-' || regexp_extract(n, '{_DROP}', 3) end as date,
 coalesce(nullif(regexp_extract(n, '{_DROP}', 6), ''), nullif(regexp_extract(n, '{_DROP}', 8), ''))::int as part, nullif(regexp_extract(n, '{_DROP}', 7), '')::int as dup,
 lower(nullif(regexp_extract(n, '{_DROP}', 9), '')) as ext from (select *, string_split(path, '/')[-1] as n from {FILES}))"""
NORM = r"trim(regexp_replace(regexp_replace(replace(replace(lower({0}), 'transkript', ''), 'protokoll', ''), '[^\p{{L}}\p{{N}}_\s]', ' ', 'g'), '\s+', ' ', 'g'))"
CANON = r"trim(regexp_replace(replace(" + NORM + r", '_', ' '), '\s+', ' ', 'g'))"
WORDS = r"list_filter(string_split_regex({0}, '\s+'), lambda w: w <> '')"
PIN = "(('0x' || substr(md5('42:' || {0}), 1, 16))::UBIGINT % 10000)::BIGINT"


# ------------------------------------------------------------------ text and chat
@query("rec_id:i prompt:s answer:s", rf"select rec_id, trim(system || chr(10) || chr(10) || \"user\", ' ' || chr(10) || chr(9) || chr(13)) as prompt, answer from {REC}".replace('\\"', '"'))
def chat_fold(t):
    prompt, answer = dataset.folded_chat(F.col("messages"))
    return records(t).select("rec_id", prompt.alias("prompt"), answer.alias("answer"))


@query("rec_id:i hash:s", f'select rec_id, substr(sha256("user"), 1, 12) as hash from {REC}')
def prompt_hash(t):
    return records(t).select("rec_id", X.prompt_hash(F.col("user")).alias("hash"))


@query("doc_id:i words:i sentences:i tokens:i", f"select doc_id, len({WORDS.format('text')}) as words, len(regexp_extract_all(text, '[.!?]+')) as sentences, length(text) // 4 as tokens from documents where text is not null and len({WORDS.format('text')}) >= 32")
def word_filter(t):
    d = t("documents").where("text is not null")
    return d.select("doc_id", X.word_count(F.col("text")).alias("words"), X.sentence_runs(F.col("text")).alias("sentences"), X.estimated_tokens(F.col("text")).alias("tokens")).where("words >= 32")


@query("kind:s n:i over:i", "select coalesce(kind, '-') as kind, count(*) as n, count(*) filter (length(text) // 4 > 512) as over from documents where text is not null group by 1")
def length_cap(t):
    d = t("documents").where("text is not null")
    return d.groupBy(F.coalesce("kind", F.lit("-")).alias("kind")).agg(F.count("*").alias("n"), F.count_if(X.estimated_tokens(F.col("text")) > 512).alias("over"))


@query("stem:s norm:s canon:s", f"select distinct stem, {NORM.format('stem')} as norm, {CANON.format('stem')} as canon from manifest where stem is not null")
def stem_keys(t):
    return t("manifest").where("stem is not null").select("stem", X.normalised_stem(F.col("stem")).alias("norm"), X.canonical_key(F.col("stem")).alias("canon")).distinct()


@query("stem:s number:i split:s", f"select distinct stem, {PIN.format(CANON.format('stem'))} as number, case when {PIN.format(CANON.format('stem'))} < 1000 then 'val' else 'train' end as split from {REC} where stem is not null")
def pinned_split(t):
    k = X.canonical_key(F.col("stem"))
    return records(t).where("stem is not null").select("stem", X.pinned_number(k).alias("number"), X.pinned_split(k).alias("split")).distinct()


_FRAME = [x.replace("'", "''") for x in dataset.FRAME]


@query("rec_id:i title:s message:s", rf"""select rec_id, title, '{_FRAME[0]}' || title || '{_FRAME[1]}' || "user" || '{_FRAME[2]}' as message from (select rec_id, "user", regexp_extract("user", '(?s)TOP: ([^\n]*)', 1) as title from {REC})""")
def framed_message(t):
    r = records(t).withColumn("title", F.regexp_extract("user", r"TOP: ([^\n]*)", 1))
    return r.select("rec_id", "title", dataset.user_message(F.col("title"), F.col("user")).alias("message"))


@query("rec_id:i json:s", f"""select rec_id, 'system,user,assistant|' || coalesce(stem, '-') || '|' || len({WORDS.format('"user"')}) || '|' || len({WORDS.format("answer")}) as json from {REC}""")
def chat_records(t):
    r = dataset.chat_record(records(t).withColumn("assistant", F.col("answer")).withColumn("strategy", F.lit("per-top")).drop("messages", "meta"), "System")
    roles = F.array_join(F.transform("messages", lambda m: m["role"]), ",")
    return r.select("rec_id", F.concat_ws("|", roles, F.coalesce("meta.stem", F.lit("-")), F.col("meta.src_tokens").cast("string"), F.col("meta.tgt_tokens").cast("string")).alias("json"))


@query("doc_id:i text:s", "select doc_id, text from documents where text is not null")
def html_unescape(t):
    d = t("documents").where("text is not null")
    esc = F.replace(F.replace("text", F.lit("&"), F.lit("&amp;")), F.lit("ü"), F.lit("&uuml;"))
    return d.select("doc_id", X.html_unescaped(esc).alias("text"))


@query("event_id:i props:s", r"""select event_id, regexp_extract('vorher ' || props || ' nachher', '(?s)\{.*\}', 0) as props from events""")
def json_extract(t):
    return t("events").select("event_id", X.json_span(F.concat(F.lit("vorher "), F.col("props"), F.lit(" nachher"))).alias("props"))


@query("stem:s committee:s pdf:s", f"select distinct stem, committee, coalesce(pdf_src, '') as pdf from {LED}")
def front_matter(t):
    led = ledger(t)
    head = files.front_matter(sinks.with_front_matter({"stem": F.col("stem"), "committee": F.col("committee"), "pdf": F.col("pdf_src")}, F.lit("Text: kein Kopf\n")))
    return led.withColumn("h", head).select(F.col("h")["stem"].alias("stem"), F.col("h")["committee"].alias("committee"), F.col("h")["pdf"].alias("pdf")).distinct()


# ------------------------------------------------------------------ filters and dataset
@query("rec_id:i", f"select rec_id from {REC} where stem is null or {CANON.format('stem')} not in (select {CANON.format('stem')} from manifest where stem is not null)")
def holdout_antijoin(t):
    return dataset.held_out(records(t), t("manifest")).select("rec_id")


def _candidates(t):
    r = records(t).withColumn("target", F.col("answer"))
    ex = r.where("author = 'N.N.' and stem is not null and top is not null").select("stem", "top").distinct()
    return dataset.split_with_overflow(dataset.judged(r, ex, 40, 2000), val_cap=900)


_EX = f"(select distinct stem, top from {REC} where author = 'N.N.' and stem is not null and top is not null)"
_JUDGED = f"""(select r.*, case when e.stem is not null then 'speaker-excluded' when len({WORDS.format("answer")}) < 40 then 'short-target' when seq_tokens > 2000 then 'over-cap' end as reason,
 case when {PIN.format(CANON.format("r.stem"))} < 1000 then 'val' else 'train' end as own, coalesce(seq_tokens > 900, false) and {PIN.format(CANON.format("r.stem"))} < 1000 as overflow
 from {REC} r left join {_EX} e on r.stem = e.stem and r.top = e.top)"""


@query("rec_id:i reason:s split:s", f"select rec_id, coalesce(reason, 'kept') as reason, case when coalesce(overflow, false) then 'train' else own end as split from {_JUDGED}")
def candidate_reasons(t):
    return _candidates(t).select("rec_id", F.coalesce("reason", F.lit("kept")).alias("reason"), "split")


_REJ = f"""(select stem, coalesce(top::varchar, 'document') as top, coalesce(reason, 'val-overflow') as reason, coalesce(seq_tokens::varchar, '-') as seq_tokens,
 case when reason is null then 'rerouted' else 'dropped' end as disposition from {_JUDGED} where reason is not null or overflow)"""


@query("stem:s top:s reason:s seq_tokens:s disposition:s", f"select * from {_REJ}")
def reject_ledger(t):
    return dataset.ledger_order(dataset.reject_ledger(_candidates(t)))


@query("reason:s n:i", f"select reason, count(*) as n from {_REJ} group by 1")
def reject_tally(t):
    return dataset.reject_tally(dataset.reject_ledger(_candidates(t)))


@query("split:s n:i moved:i", f"select case when coalesce(overflow, false) then 'train' else own end as split, count(*) as n, count(*) filter (overflow) as moved from {_JUDGED} where reason is null group by 1")
def val_overflow_reroute(t):
    return _candidates(t).where("reason is null").groupBy("split").agg(F.count("*").alias("n"), F.count_if("overflow").alias("moved"))


@query(
    "split:s sessions:i records:i seq_tokens_min:i seq_tokens_max:i seq_tokens_median:i",
    f"""select split, count(distinct stem) as sessions, count(*) as records, min(seq_tokens) as seq_tokens_min, max(seq_tokens) as seq_tokens_max,
    list_sort(list(seq_tokens) filter (seq_tokens is not null))[(count(seq_tokens) // 2 + 1)::int] as seq_tokens_median
    from (select *, case when coalesce(overflow, false) then 'train' else own end as sp from {_JUDGED} where reason is null) group by sp as split""".replace("select split,", "select sp as split,").replace("group by sp as split", "group by sp"),
)
def dataset_summary(t):
    return dataset.summary(_candidates(t).where("reason is null").select("stem", "split", "seq_tokens"), ["seq_tokens"])


@query(
    "stem:s tops:s",
    f"""select stem, array_to_string(list(top order by (try_cast(top as int) is null), coalesce(try_cast(top as int), 0), top), ',') as tops
    from (select stem, top::varchar as top from {_EX} union select stem, coalesce(top::varchar, 'document') from {REC} where seq_tokens > 2000 and stem is not null) group by stem""",
)
def exclusion_merge(t):
    r = records(t)
    ex = r.where("author = 'N.N.' and stem is not null and top is not null").select("stem", "top").distinct()
    long = r.where("seq_tokens > 2000 and stem is not null").select("stem", F.coalesce(F.col("top").cast("string"), F.lit("document")).alias("top"))
    return dataset.merged_exclusions(ex, long).select("stem", F.array_join("tops", ",").alias("tops"))


@query("stem:s", f"select distinct stem from {REC} where stem is not null except select distinct stem from {REC} where stem is not null and top <= 3")
def untagged_sessions(t):
    r = records(t).where("stem is not null")
    return dataset.untagged_sessions(r, r.where("top <= 3"))


# ------------------------------------------------------------------ quality
_MET = r"""(select doc_id, kind, stem, text, length(text) as chars, len({w}) as words, case when text = '' then 0 else len(string_split(regexp_replace(text, '\n\z', ''), chr(10))) end as lines,
 len(regexp_extract_all(text, '[\[(]\d{{1,2}}:\d{{2}}:\d{{2}}')) as timestamp_leaks, len(regexp_extract_all(text, '<SD-[A-Z]+>')) as tag_leaks,
 len(regexp_extract_all(text, '(?im)^##\s*Zu\s+TOP\s*\d+')) as top_sections, len(regexp_extract_all(text, '\d{{1,3}}\s+:\s+\d{{1,3}}\s+:\s+\d{{1,3}}')) as vote_triples,
 len(list_filter({w}, lambda x: length(x) > 30 or (length(x) >= 4 and (len(list_distinct(string_split(x, ''))) <= 2 or length(regexp_replace(x, '[^\p{{L}}\p{{N}}]', '', 'g')) < 0.4 * length(x))))) as gibberish
 from documents where text is not null)""".format(w=WORDS.format("text"))
_RUN = r"""(select doc_id, max(n) as max_repeat from (select doc_id, island, count(*) as n from (select *, sum(case when line is distinct from before then 1 else 0 end) over (partition by doc_id order by k) as island
 from (select *, lag(line) over (partition by doc_id order by k) as before from (select doc_id, k, trim(l, ' ' || chr(9) || chr(13)) as line from
 (select doc_id, unnest(string_split(text, chr(10))) as l, unnest(range(len(string_split(text, chr(10))))) as k from documents where text is not null)) where line <> '')) group by all) group by doc_id)"""


@query("doc_id:i chars:i words:i lines:i timestamp_leaks:i tag_leaks:i top_sections:i vote_triples:i gibberish:i max_repeat:i", f"select m.*, coalesce(r.max_repeat, 0) as max_repeat from {_MET} m left join {_RUN} r using (doc_id)")
def degeneration_metrics(t):
    return t("documents").where("text is not null").select("doc_id", *[c.alias(k) for k, c in quality.metrics(F.col("text")).items()])


@query("doc_id:i degenerate:b", f"select doc_id, timestamp_leaks > 0 or tag_leaks > 0 or coalesce(max_repeat, 0) >= 3 or gibberish * 10 >= greatest(words, 1) as degenerate from {_MET} left join {_RUN} using (doc_id)")
def quality_flags(t):
    m = quality.metrics(F.col("text"))
    return t("documents").where("text is not null").select("doc_id", quality.degenerate(m["timestamp_leaks"], m["tag_leaks"], m["max_repeat"], m["gibberish"], m["words"]).alias("degenerate"))


@query("doc_id:i gold_words:i ratio:d", f"select doc_id, coalesce(nullif(g, 0), 1) as gold_words, words::double / coalesce(nullif(g, 0), 1) as ratio from {_MET} left join (select stem, max(words) as g from {_MET} where kind = 'protocol' and stem is not null group by 1) using (stem) where kind = 'transcript'")
def gold_ratio(t):
    d = t("documents").where("text is not null").select("doc_id", "stem", "kind", X.word_count(F.col("text")).alias("words"))
    gold = d.where("kind = 'protocol' and stem is not null").groupBy("stem").agg(F.max("words").alias("words"))
    return quality.gold_ratio(d.where("kind = 'transcript'"), gold, "stem")


@query(
    "author:s words_delta:i",
    f"""select author, max(w) filter (decode = 'antirep') - max(w) filter (decode = 'baseline') as words_delta from (select author, decode, arg_max(w, rec_id) as w from
    (select author, rec_id, case when split = 'val' then 'antirep' else 'baseline' end as decode, len({WORDS.format("answer")}) as w from {REC} where author is not null and split in ('train', 'val')) group by all) group by author having count(*) = 2""",
)
def preset_delta(t):
    r = records(t).where("author is not null and split in ('train', 'val')")
    r = r.select("author", F.col("rec_id").alias("name"), F.when(F.col("split") == "val", "antirep").otherwise("baseline").alias("decode"), X.word_count(F.col("answer")).alias("words"))
    return quality.preset_delta(r, ["author"], ["words"])


@query("latest:s", f"select max(name) as latest from (select string_split(raw_dir, '/')[-1] as name from {LED}) where regexp_matches(name, '^[0-9]')")
def latest_run(t):
    return quality.latest_run(ledger(t).select(F.element_at(F.split("raw_dir", "/"), -1).alias("name")))


@query("stem:s name:s framework:s", f"select distinct stem, stem || '__' || case when committee like 'AV%' then 'unsloth' else 'peft' end || '__per-top__baseline.md' as name, case when committee like 'AV%' then 'unsloth' else 'peft' end as framework from {LED}")
def output_names(t):
    led = ledger(t).withColumn("framework", quality.framework_of(F.when(F.col("committee").startswith("AV"), F.concat(F.lit("unsloth-"), "committee")).otherwise(F.col("committee")), ["unsloth"]))
    return led.select("stem", quality.output_name(F.col("stem"), F.col("framework"), F.lit("per-top"), F.lit("baseline")).alias("name"), "framework").distinct()


@query("stem:s rank:i", f"select stem, row_number() over (order by n, stem) as rank from (select stem, sum(length(text)) as n from {SEG} group by stem having sum(length(text)) is not null)")
def shortest_first(t):
    s = segments(t).groupBy("stem").agg(F.sum(F.length("text")).alias("n")).where("n is not null")
    # positions over range partitions, not in one
    return inventory.positions(s, ["n", "stem"]).withColumn("rank", F.col("position") + 1)


# ------------------------------------------------------------------ sections
_SECT = r"""(with p as (select {k}, unnest(string_split(regexp_replace({c}, '(?im)^([ \t]*#{{1,6}}[ \t]*zu\s+TOP\s*\d+\b)', chr(1) || '\1', 'g'), chr(1))) as piece,
 unnest(range(len(string_split(regexp_replace({c}, '(?im)^([ \t]*#{{1,6}}[ \t]*zu\s+TOP\s*\d+\b)', chr(1) || '\1', 'g'), chr(1))))) as i from {t}),
 n as (select *, nullif(regexp_extract(piece, '(?i)^[ \t]*#{{1,6}}[ \t]*zu\s+TOP\s*(\d+)', 1), '')::int as no from p),
 m as (select *, coalesce(no > coalesce(max(no) over (partition by {k} order by i rows between unbounded preceding and 1 preceding), 0), false) as keep from n),
 s as (select *, sum(keep::int) over (partition by {k} order by i) as sec from m)
 select {k}, max(no) filter (keep) as top, trim(string_agg(piece, '' order by i), ' ' || chr(10) || chr(9) || chr(13)) as section from s where sec > 0 group by {k}, sec)"""
_DOCS = "(select doc_id, stem, kind, text from documents where text is not null)"


@query("doc_id:i top:i section:s", "select * from " + _SECT.format(k="doc_id", c="text", t=_DOCS))
def section_slices(t):
    return sections.minutes_sections(t("documents").where("text is not null"), ["doc_id"])


@query(
    "stem:s pt:i n:i",
    f"""select stem, pt, count(*) as n from (select *, coalesce(max(no) over (partition by stem, pt order by ord, k rows between unbounded preceding and 1 preceding), 0) as m
    from (select stem, pt, ord, unnest(regexp_extract_all(text, '\\d+'))::bigint as no, unnest(range(len(regexp_extract_all(text, '\\d+')))) as k from {SEG})) where no > m group by all""",
)
def monotonic_sections(t):
    s = segments(t).select("stem", "pt", "ord", F.posexplode(F.regexp_extract_all("text", F.lit(r"(\d+)"), F.lit(1))).alias("k", "no")).withColumn("no", F.col("no").cast("bigint"))
    return sections.rising(s, SEG_KEYS, ["ord", "k"], "no").groupBy(*SEG_KEYS).agg(F.count("*").alias("n"))


@query(
    "doc_id:i top:i title:s",
    rf"""select doc_id, top, case when x <> '' then x else 'TOP ' || top end as title from (select doc_id, top, trim(regexp_replace(regexp_extract(text, '(?im)^#*\s*Zu\s+TOP\s*' || top || '\s+(.+)$', 1), '\s+', ' ', 'g'), ' :-–') as x
    from (select doc_id, regexp_replace(text, '(?im)^(## Zu TOP [02468]):', '\1', 'g') as text, unnest(list_distinct(list_transform(regexp_extract_all(text, '(?im)^#*\s*Zu\s+TOP\s*(\d{{1,9}})', 1), lambda x: x::int))) as top from documents where text is not null))""",
)
def section_titles(t):
    d = t("documents").where("text is not null").withColumn("text", F.regexp_replace("text", r"(?im)^(## Zu TOP [02468]):", "$1"))
    d = d.withColumn("top", F.explode(F.array_distinct(F.transform(F.regexp_extract_all("text", F.lit(r"(?im)^#*\s*Zu\s+TOP\s*(\d{1,9})"), F.lit(1)), lambda x: x.cast("int")))))
    return d.select("doc_id", "top", sections.title_of(F.col("text"), F.col("top")).alias("title"))


_TWO = """(select stem, string_agg(text, chr(10) order by ts, doc_id) as text from (select stem, text, min(coalesce(created_at, '0001-01-01'::timestamp)) as ts, arg_min(doc_id, struct_pack(a := coalesce(created_at, '0001-01-01'::timestamp), b := doc_id)) as doc_id
 from documents where kind = '{0}' and stem is not null and text is not null group by stem, text) group by stem)"""


def _together(t, kind):
    """All different documents of a kind of a sitting as one text, the oldest first."""
    d = t("documents").where((F.col("kind") == kind) & F.col("stem").isNotNull() & F.col("text").isNotNull()).groupBy("stem", "text").agg(F.min(F.struct("created_at", "doc_id")).alias("at"))
    return d.groupBy("stem").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "text"))), lambda x: x["text"]), "\n").alias("text"))


@query(
    "stem:s top:i both:b",
    f"select coalesce(a.stem, b.stem) as stem, coalesce(a.top, b.top) as top, a.top is not null and b.top is not null as both from {_SECT.format(k='stem', c='text', t=_TWO.format('protocol'))} a full join {_SECT.format(k='stem', c='text', t=_TWO.format('report'))} b on a.stem = b.stem and a.top = b.top",
)
def two_pass_merge(t):
    one = lambda kind: sections.minutes_sections(_together(t, kind), ["stem"])
    j = one("protocol").select("stem", "top", F.lit(1).alias("x")).join(one("report").select("stem", "top", F.lit(1).alias("y")), ["stem", "top"], "full")
    return j.select("stem", "top", (F.col("x").isNotNull() & F.col("y").isNotNull()).alias("both"))


_HEAD = r"(?i)^#{1,6}[ \t]*Zu\s+TOP\s*(\d+)[ \t]*:?[ \t]*([^\n]*)"
_BLANKS = "' ' || chr(10) || chr(9)"
_PARTS = f"""(select * exclude (inline, paras, n), case when has then trim(regexp_replace(concat_ws(' ', inline, nullif(array_to_string(paras[1:n], ' '), '')), '\\s+', ' ', 'g'), ' :-–') else '' end as title,
 case when has then trim(array_to_string(paras[n + 1:], chr(10) || chr(10)), {_BLANKS}) else trim(section, {_BLANKS}) end as body
 from (select *, case when inline = '' then 0 else coalesce(list_position(list_transform(paras, lambda p, i: i <= 3 and trim(p, {_BLANKS}) <> '' and length(trim(p, {_BLANKS})) <= 120 and not starts_with(trim(p, {_BLANKS}), '#')
   and not regexp_matches(trim(p, {_BLANKS}), '[.!?]$') and not regexp_matches(trim(p, {_BLANKS}), '{sections.TITLE_STOP}')), false) - 1, len(paras)) end as n
  from (select *, regexp_matches(section, '{_HEAD}') as has, trim(regexp_extract(section, '{_HEAD}', 2)) as inline, string_split_regex(ltrim(regexp_replace(section, '{_HEAD}', ''), chr(10)), '\\n\\s*\\n') as paras from {{0}})))"""


@query("doc_id:i top:i title:s body:s", "select doc_id, top, title, body from " + _PARTS.replace("{0}", "(select * from " + _SECT.format(k="doc_id", c="text", t=_DOCS) + ")"))
def section_parts(t):
    title, body = sections.heading_and_body(F.col("section"))
    return sections.minutes_sections(t("documents").where("text is not null"), ["doc_id"]).select("doc_id", "top", title.alias("title"), body.alias("body"))


_BOTH = "(select doc_id, text as decision, replace(replace(text, 'Zu TOP 1:', 'Zu TOP 5:'), '## Zu TOP 2:', '## Zu TOP 2') as discussion from documents where text is not null)"
_PASS = {c: "(select * from " + _PARTS.replace("{0}", "(select * from " + _SECT.format(k="doc_id", c=c, t=_BOTH) + ")") + ")" for c in ("decision", "discussion")}


@query(
    "doc_id:i top:i section:s",
    rf"""select doc_id, top, concat_ws(chr(10) || chr(10), rtrim('## Zu TOP ' || top || ':' || case when title <> '' then ' ' || title else '' end), nullif(bb, ''), case when rb <> '' then case when bb <> '' then 'Aus der Beratung' || chr(10) || chr(10) || rb else rb end end) as section
    from (select coalesce(a.doc_id, b.doc_id) as doc_id, coalesce(a.top, b.top) as top, case when coalesce(b.title, '') <> '' then b.title else coalesce(a.title, '') end as title, coalesce(a.body, '') as bb, coalesce(b.body, '') as rb
    from {_PASS["decision"]} a full join {_PASS["discussion"]} b on a.doc_id = b.doc_id and a.top = b.top)""",
)
def merged_passes(t):
    """Minutes with both passes: the sections of the decisions, and those of the discussion under other numbers and titles."""
    other = F.replace(F.replace("text", F.lit("Zu TOP 1:"), F.lit("Zu TOP 5:")), F.lit("## Zu TOP 2:"), F.lit("## Zu TOP 2"))
    x = F.concat(F.lit("## Beschlüsse und Festlegungen\n\n"), "text", F.lit("\n\n## Aus der Beratung\n\n"), other, F.lit("\n\n## Anlage 1\n\n## Zu TOP 99: weg"))
    return sections.merged_sections(t("documents").where("text is not null").select("doc_id", x.alias("text")), ["doc_id"])


_AG = r"""(select {k}, top, arg_min(title, i) as title from (select {k}, i, coalesce(nullif(regexp_extract(l, '^-\s*(\d+)(?:\.\d+)?\s+(.+)$', 1), ''), nullif(regexp_extract(l, '^\|\s*(\d+)(?:\.\d+)?\s*\|\s*([^|]+?)\s*\|', 1), ''),
 nullif(regexp_extract(l, '^(\d+)\.\s+(\S.*)$', 1), ''), nullif(regexp_extract(l, '^(\d+)\s+(\S.*)$', 1), ''))::int as top,
 trim(coalesce(nullif(regexp_extract(l, '^-\s*(\d+)(?:\.\d+)?\s+(.+)$', 2), ''), nullif(regexp_extract(l, '^\|\s*(\d+)(?:\.\d+)?\s*\|\s*([^|]+?)\s*\|', 2), ''), nullif(regexp_extract(l, '^(\d+)\.\s+(\S.*)$', 2), ''), regexp_extract(l, '^(\d+)\s+(\S.*)$', 2))) as title
 from (select {k}, i, trim(l, ' ' || chr(9) || chr(13)) as l from (select {k}, unnest(string_split(r, chr(10))) as l, unnest(range(len(string_split(r, chr(10))))) as i from (select {k}, regexp_extract(text, '(?is)Tagesordnung(.*)$', 1) as r from {t}))))
 where top is not null and not regexp_matches(title, '^(\(|\d|(?i:\(?(teilweise\s+)?(öffentlich|nicht)))') group by {k}, top)"""


@query("doc_id:i top:i title:s", "select * from " + _AG.format(k="doc_id", t="(select * from documents where kind = 'agenda' and text is not null)"))
def agenda_items(t):
    return agenda.parsed_agenda(t("documents").where("kind = 'agenda' and text is not null"), ["doc_id"])


@query(
    "stem:s top:i side:s",
    f"select coalesce(a.stem, b.stem) as stem, coalesce(a.top, b.top) as top, case when b.top is null then 'cover' when a.top is null then 'minutes' else 'both' end as side from {_AG.format(k='stem', t=_TWO.format('agenda'))} a full join {_SECT.format(k='stem', c='text', t=_TWO.format('protocol'))} b on a.stem = b.stem and a.top = b.top",
)
def agenda_difference(t):
    a = agenda.parsed_agenda(_together(t, "agenda"), ["stem"]).select("stem", "top", F.lit(1).alias("x"))
    b = sections.minutes_sections(_together(t, "protocol"), ["stem"]).select("stem", "top", F.lit(1).alias("y"))
    return a.join(b, ["stem", "top"], "full").select("stem", "top", F.when(F.col("y").isNull(), "cover").when(F.col("x").isNull(), "minutes").otherwise("both").alias("side"))


@query(
    "stem:s turn_ix:i top:i",
    rf"""select stem, turn_ix, top from (select *, coalesce(max(top) over (partition by stem order by turn_ix, k rows between unbounded preceding and 1 preceding), 0) as m from
    (select stem, turn_ix, unnest(list_transform(regexp_extract_all(text, '(?i)\b(?:TOP|Tagesordnungspunkt)\s*(\d+)', 1), lambda x: x::int)) as top, unnest(range(len(regexp_extract_all(text, '(?i)\b(?:TOP|Tagesordnungspunkt)\s*(\d+)', 1)))) as k
    from (select stem, pt * 100000 + ord as turn_ix, 'Wir kommen zu TOP ' || ord || ' und Tagesordnungspunkt ' || (ord % 5) || '. ' || coalesce(text, '') as text from {SEG}))) where top > m""",
)
def announced_items(t):
    s = segments(t).withColumn("turn_ix", F.col("pt") * 100000 + F.col("ord"))
    s = s.withColumn("text", F.concat(F.lit("Wir kommen zu TOP "), F.col("ord").cast("string"), F.lit(" und Tagesordnungspunkt "), (F.col("ord") % 5).cast("string"), F.lit(". "), F.coalesce("text", F.lit(""))))
    return sections.announced(s, ["stem"])


# ------------------------------------------------------------------ cleaning
@query("doc_id:i text:s", r"""select doc_id, regexp_replace(regexp_replace(x, '(\S) {2,}(\S)', '\1 \2', 'g'), '(\S) {2,}(\S)', '\1 \2', 'g') as text from (select doc_id, replace(text, ', ', ',   ') as x from documents where text is not null)""")
def multispace_collapse(t):
    return t("documents").where("text is not null").select("doc_id", cleaning.spaces_collapsed(F.replace("text", F.lit(", "), F.lit(",   "))).alias("text"))


@query("doc_id:i text:s", r"""select doc_id, trim(regexp_replace(x, '\n{3,}', chr(10) || chr(10), 'g'), ' ' || chr(10) || chr(9) || chr(13)) || chr(10) as text from (select doc_id, replace(text, '. ', '.' || chr(10) || chr(10) || chr(10)) as x from documents where text is not null)""")
def blank_collapse(t):
    return t("documents").where("text is not null").select("doc_id", cleaning.blank_lines_collapsed(F.replace("text", F.lit(". "), F.lit(".\n\n\n"))).alias("text"))


@query("doc_id:i text:s", "select doc_id, 'Siehe Vorlage hier. ' || text as text from documents where text is not null")
def hyperlink_unwrap(t):
    return t("documents").where("text is not null").select("doc_id", X.hyperlinks_unwrapped(F.concat(F.lit("Siehe [Vorlage](https://beispiel.test/a) [hier](mailto:a@b.test). "), "text")).alias("text"))


@query(
    "doc_id:i text:s",
    r"""select doc_id, replace(regexp_replace(regexp_replace(text, '([a-zäöüß])- (und|oder|bzw\.?|sowie)\b', '\1-' || chr(1) || '\2', 'g'), '([a-zäöüß])- +([a-zäöüß])', '\1\2', 'g'), chr(1), ' ') as text from (select doc_id, 'Schul- kinder, Bildungs- und Sport. ' || text as text from documents where text is not null)""",
)
def hyphen_join(t):
    return t("documents").where("text is not null").select("doc_id", cleaning.hyphens_joined(F.concat(F.lit("Schul- kinder, Bildungs- und Sport. "), "text")).alias("text"))


@query(
    "doc_id:i text:s",
    r"""select doc_id, regexp_replace(regexp_replace(regexp_replace(x, '(?m)^\d{1,3}\s+.*(?:Vgl\.|Anlage).*$', '', 'g'), '(?m)([.!?])[ \t]+\d{1,3}[ \t]*$', '\1', 'g'), '[ \t]*\(Anlage\)', '', 'g') as text
    from (select doc_id, '12 Vgl. Anlage 3' || chr(10) || text || chr(10) || 'Ende (Anlage) des Satzes. 7' as x from documents where text is not null)""",
)
def footnotes_removed(t):
    x = F.concat(F.lit("12 Vgl. Anlage 3\n"), F.col("text"), F.lit("\nEnde (Anlage) des Satzes. 7"))
    return t("documents").where("text is not null").select("doc_id", cleaning.without_footnotes(x).alias("text"))


_INSTITUTION = "Kreistag Nordmoor"
_FURNITURE = [
    "| Kreistag Nordmoor | Protokoll | S. 3 |", "|---|---|---|", "| a | b | c |", "HA", "## Kreistag Nordmoor", "P-HA 8/22", "Montag Vormittag", "| Tag | Betrag im Kreistag Anderswo | S. 5 |", "| --- | --- |", "| x | y |", "",
    "ABJS", "12. (öffentliche) Sitzung des Ausschusses", "", "05.06.2037", "(Dieses Protokoll wurde durch den Ausschuss gemäß § 83 GO bestätigt.)", "- Zu TOP 9", "<!-- image -->", "##", "Siehe [Vorlage](https://beispiel.test/a).",
    "12 Vgl. Anlage 3", "Das kostet viel. 7", "Die  Schul- kinder und Bildungs- und Sport (Anlage)", "SBü", "Ende im HA", "Noch eines ABJS.", "## Anlage 1", "weg",
]


def _sql_lines(xs):
    return " || chr(10) || ".join("'" + x.replace("'", "''") + "'" for x in xs)


def _clean_sql(x: str) -> str:
    """The steps of the cleaner in order, each as one more layer."""
    c = cleaning
    q = lambda p: "'" + p.replace("(?U)", "").replace("'", "''") + "'"
    step = lambda x, p, r="": f"regexp_replace({x}, {q(p)}, '{r}', 'g')"
    x = step(x, c.ATTACHMENTS)
    x = step(x, c.PAGE_TABLE[0] + _INSTITUTION + c.PAGE_TABLE[1])
    x = step(x, c.PLAIN_FOOTER)
    x = step(step(x, c.NAME_LINE[0] + _INSTITUTION + c.NAME_LINE[1]), c.NUMBER_LINE)
    x = step(step(x, c.RATIFIED), c.BULLET_TOP, r"## \1")
    return x


def clean_sql(source: str) -> str:
    """(doc_id, body) of a table (doc_id, x) of bodies."""
    return rf"""(select doc_id, trim(regexp_replace(y, '\n{{3,}}', chr(10) || chr(10), 'g'), ' ' || chr(10) || chr(9) || chr(13)) || chr(10) as body from (select doc_id,
 replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(z, '(\S) {{2,}}(\S)', '\1 \2', 'g'), '(\S) {{2,}}(\S)', '\1 \2', 'g'), '([a-zäöüß])- +(und|oder|bzw\.?|sowie)\b', '\1-' || chr(1) || '\2', 'g'), '([a-zäöüß])- +([a-zäöüß])', '\1\2', 'g'), '-' || chr(1), '- ') as y
 from (select doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(w, '{cleaning.IMAGE}', '', 'g'), '\[([^\]]*)\]\([^)]*\)', '\1', 'g'), '(?m)^\d{{1,3}}\s+.*(?:Vgl\.|Anlage).*$', '', 'g'), '{cleaning.FOOTNOTE_MARK}', '\1', 'g'), '{cleaning.ATTACHMENT_MARK}', '', 'g'), '{cleaning.EMPTY_HEADING}', '', 'g') as z
 from (select doc_id, list_reduce(list_prepend(regexp_replace(v, '{cleaning.CODE_LINE}', '', 'g'), list_sort(list_transform(list_distinct(regexp_extract_all(v, '{cleaning.CODE_LINE}', 1)), lambda x: printf('%03d', 999 - length(x)) || x))),
  lambda a, x: regexp_replace(a, '{cleaning.CODE_END[0]}' || substr(x, 4) || '{cleaning.CODE_END[1]}', '', 'g')) as w
 from (select doc_id, {_clean_sql("x")} as v from {source})))))"""


_CLEAN = clean_sql(f"(select doc_id, '## Beschlüsse und Festlegungen' || chr(10) || chr(10) || text || chr(10) || {_sql_lines(_FURNITURE)} as x from documents where text is not null)")


@query("doc_id:i cover:s body:s matched:b", f"select doc_id, 'Deckblatt' || chr(10) || chr(10) as cover, body, true as matched from {_CLEAN} union all select doc_id, text, '', false from documents where text is not null")
def clean_minutes(t):
    """Texts with all furniture the cleaner knows, and the same texts without the heading of the decisions."""
    d = t("documents").where("text is not null").select("doc_id", "text")
    x = F.concat(F.lit("Deckblatt\n\n## Beschlüsse und Festlegungen\n\n"), "text", F.lit("\n" + "\n".join(_FURNITURE)))
    return cleaning.clean_minutes(d.select("doc_id", x.alias("text")).unionByName(d), institutions=[_INSTITUTION])


# ------------------------------------------------------------------ turns and segments
@query("stem:s pt:i ord:i stamp:s", rf"""select stem, pt, ord, printf('%02d:%02d:%02d.%03d', ms // 3600000, ms // 60000 % 60, ms // 1000 % 60, ms % 1000) as stamp from (select *, round(greatest(start, 0) * 1000)::bigint as ms from {SEG} where start is not null)""")
def ts_format(t):
    return segments(t).where("start is not null").select("stem", "pt", "ord", X.clock(F.col("start")).alias("stamp"))


@query("stem:s pt:i ord:i carried:s", f"select stem, pt, ord, last_value(speaker ignore nulls) over (partition by stem, pt order by ord rows between unbounded preceding and current row) as carried from {SEG}")
def locf_speaker(t):
    return turns.carried(segments(t), SEG_KEYS, "ord", "speaker", "carried")


_ISL = f"""(select *, sum(case when rn = 1 or speaker is distinct from before then 1 else 0 end) over (partition by stem, pt order by ord) as island from
 (select *, lag(speaker) over (partition by stem, pt order by ord) as before, row_number() over (partition by stem, pt order by ord) as rn from {SEG}))"""


@query(
    "stem:s pt:i island:i speaker:s start:d end:d n:i",
    f'select stem, pt, island, any_value(speaker) as speaker, min(start) as start, max("end") as "end", count(*) as n from {_ISL} group by stem, pt, island having bool_or(trim(coalesce(text, \'\')) <> \'\')',
)
def island_groups(t):
    return turns.speaker_groups(segments(t).withColumn("text", F.coalesce("text", F.lit(""))), SEG_KEYS).withColumn("n", F.size("segments"))


def _markup(t) -> DataFrame:
    """Transcripts in markup from the segments: a tag before every segment, and a line."""
    s = segments(t).withColumn("text", F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"[^\p{L}\p{N} ]", ""))).withColumn("label", F.trim(F.coalesce("label", F.lit("SPEAKER_99"))))
    block = F.concat(F.lit("<SD-TOP>TOP "), (F.col("ord") + 1).cast("string"), F.lit("</SD>\n<SD-SPK>"), "label", F.lit("</SD>\n[00:00:01.000 --> 00:00:02.000] "), "text")
    g = s.withColumn("key", F.concat_ws("#", "stem", "pt")).groupBy("key").agg(F.array_sort(F.collect_list(F.struct("ord", block.alias("b")))).alias("bs"))
    return g.select("key", F.array_join(F.transform("bs", lambda x: x["b"]), "\n\n").alias("text"))


_MARK = rf"""(select stem || '#' || pt as key, ord, trim(coalesce(label, 'SPEAKER_99')) as label, trim(regexp_replace(coalesce(text, ''), '[^\p{{L}}\p{{N}} ]', '', 'g')) as text, row_number() over (partition by stem, pt order by ord) as turn_ix from {SEG})"""


@query("key:s turn_ix:i label:s text:s top:i", f"select key, turn_ix, label, text, ord + 1 as top from {_MARK}")
def turn_parse(t):
    return turns.parse_turns(_markup(t), "key")


@query(
    "key:s rendered:s",
    f"""select key, string_agg(line, chr(10) order by island) as rendered from (select key, island, min(label) || ': ' || string_agg(text, ' ' order by ord) as line from
    (select *, sum(case when label is distinct from b then 1 else 0 end) over (partition by key order by ord) as island from (select *, lag(label) over (partition by key order by ord) as b from {_MARK} where text <> '')) group by all) group by key""",
)
def turn_render(t):
    return turns.render(_markup(t), "key").where("rendered <> ''")


_NAMES = ["Alma Berg", "Bodo Cramer", "Cilly Dahl", "Dora Ems", "Egon Frey"]


@query(
    "key:s label:s name:s",
    f"""select key, label, list_extract({_NAMES!r}, ((row_number() over (partition by key order by first) - 1) % 5 + 1)::int) as name from (select stem || '#' || pt as key, speaker as label, min(ord) as first from {SEG} where regexp_full_match(speaker, 'SPEAKER_[0-9]+') group by all)""",
)
def speaker_placeholders(t):
    s = segments(t).where(F.col("speaker").rlike(r"^SPEAKER_\d+$")).withColumn("key", F.concat_ws("#", "stem", "pt"))
    d = s.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("ord", "speaker"))).alias("x")).select("key", F.array_join(F.transform("x", lambda x: x["speaker"]), " sagt; ").alias("text"))
    return turns.placeholders(d, _NAMES, "key").select("key", F.explode("labels").alias("l")).select("key", "l.label", "l.name")


@query("key:s text:s", f"select key, string_agg('<SD-SPK>' || case when label like 'SPEAKER%' then 'Name ' || right(label, 2) else label end || '</SD>', chr(10) order by ord) as text from {_MARK} group by key")
def relabelled_tags(t):
    s = segments(t).withColumn("label", F.trim(F.coalesce("label", F.lit("SPEAKER_99")))).withColumn("key", F.concat_ws("#", "stem", "pt"))
    d = s.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("ord", "label"))).alias("x")).select("key", F.array_join(F.transform("x", lambda x: F.concat(F.lit("<SD-SPK>"), x["label"], F.lit("</SD>"))), "\n").alias("text"))
    m = s.where("label like 'SPEAKER%'").select("key", "label", F.concat(F.lit("Name "), F.right("label", F.lit(2))).alias("name")).distinct()
    return turns.relabelled(d, m, "key")


def _asr(t):
    s = segments(t)
    return s.drop("speaker"), s.where("speaker is not null").withColumn("start", F.col("start") + 2.5).select(*SEG_KEYS, "start", "end", "speaker")


_ASR = SEG
_DIA = f"""(select stem, pt, start + 2.5 as start, "end", speaker from {SEG} where speaker is not null)"""
_OV = f"""(select stem, pt, ord, speaker from (select a.stem, a.pt, a.ord, d.speaker, row_number() over (partition by a.stem, a.pt, a.ord order by least(a."end", d."end") - greatest(a.start, d.start) desc, d.start, d."end", d.speaker desc) as rn
 from {_ASR} a join {_DIA} d on a.stem = d.stem and a.pt = d.pt and d.start < a."end" and d."end" > a.start and d."end" > d.start and a.start is not null) where rn = 1)"""


@query("stem:s pt:i ord:i overlap_speaker:s", f"select a.stem, a.pt, a.ord, o.speaker as overlap_speaker from {_ASR} a left join {_OV} o using (stem, pt, ord)")
def overlap_assign(t):
    return intervals.overlap_assigned(*_asr(t), SEG_KEYS)


@query(
    "stem:s pt:i ord:i speaker:s",
    f"""with o as (select a.*, v.speaker as ov, row_number() over (partition by a.stem, a.pt order by a.ord) as rn from {_ASR} a left join {_OV} v using (stem, pt, ord)),
    n as (select stem, pt, ord, speaker as near from (select o.stem, o.pt, o.ord, d.speaker, row_number() over (partition by o.stem, o.pt order by abs((o.start + o."end") / 2 - (d.start + d."end") / 2) nulls last, d.start nulls last, d.speaker) as k
    from o join {_DIA} d on o.stem = d.stem and o.pt = d.pt where o.rn = 1 and o.ov is null and o.start is not null and o."end" is not null and d.start is not null and d."end" is not null) where k = 1)
    select stem, pt, ord, coalesce(last_value(coalesce(ov, near) ignore nulls) over (partition by stem, pt order by ord rows between unbounded preceding and current row), 'UNKNOWN') as speaker from o left join n using (stem, pt, ord)""",
)
def nearest_fallback(t):
    a, d = _asr(t)
    return intervals.assigned(a, d, SEG_KEYS)


def budget_sql(rows: str, keys: str, order: str, cost: str, budget: int, floor: int = 0) -> str:
    """Windows by a fold over each session's costs in order; the state of each row is the one before with a row added."""
    return f"""(select {keys}, unnest(os) as {order}, unnest(ws) as "window" from (select {keys}, os, list_reduce(list_prepend([-1::bigint, 0], list_transform(cs, lambda c: [c])), lambda a, x:
      case when a[1] < 0 or a[2] + x[1] > {budget} then list_concat([a[1] + 1, {floor} + x[1]], a[3:], [a[1] + 1]) else list_concat([a[1], a[2] + x[1]], a[3:], [a[1]]) end)[3:] as ws
      from (select {keys}, list({order} order by {order}) as os, list(({cost})::bigint order by {order}) as cs from {rows} group by {keys})))"""


@query("stem:s pt:i ord:i window:i", "select * from " + budget_sql(f"(select stem, pt, ord, coalesce(text, '') as text from {SEG})", "stem, pt", "ord", "length(left(text, 300)) // 4 + 8", 200))
def budget_tiling(t):
    return agenda.budget_windows(segments(t).withColumn("text", F.coalesce("text", F.lit(""))), SEG_KEYS, "ord", agenda.turn_cost(F.col("text")), 200)


# ------------------------------------------------------------------ people and resolution
_NR = r"(?s)^(.*?)\s*\((.*)\)\s*$"
_BARE = f"case when regexp_matches(full_name, '{_NR}') then trim(regexp_extract(full_name, '{_NR}', 1)) else trim(full_name) end"
_TITLES = ", ".join(f"'{x}'" for x in people.TITLES)
_TOK = rf"list_filter(string_split_regex({_BARE}, '\s+'), lambda x: x <> '' and lower(x) not in ({_TITLES}))"
_TOK0 = rf"list_filter(string_split_regex({_BARE}, '\s+'), lambda x: x <> '')"
_ATT = "(select distinct full_name from attendance where full_name is not null)"


@query("full_name:s bare:s role:s", f"select full_name, {_BARE} as bare, trim(regexp_extract(full_name, '{_NR}', 2)) as role from {_ATT}")
def name_split(t):
    bare, role = people.name_and_role(F.col("full_name"))
    return t("attendance").where("full_name is not null").select("full_name", bare.alias("bare"), role.alias("role")).distinct()


@query("full_name:s key:s surname:s", f"select full_name, lower(array_to_string(ts, ' ')) as key, coalesce(lower(ts[-1]), '') as surname from (select full_name, case when len({_TOK}) > 0 then {_TOK} else {_TOK0} end as ts from {_ATT})")
def canonical_names(t):
    key, surname = people.canonical_name(F.col("full_name"))
    return t("attendance").where("full_name is not null").select("full_name", key.alias("key"), surname.alias("surname")).distinct()


_NT = r"^[A-ZÄÖÜ][\p{L}\p{N}_.\-'']*$"
_PARTICLES = ", ".join(f"'{x}'" for x in people.PARTICLES)


@query("full_name:s person:b", f"select full_name, coalesce(len(ts) between 1 and 5 and regexp_matches(ts[-1], '{_NT}') and len(list_filter(ts, lambda x: not (regexp_matches(x, '{_NT}') or lower(x) in ({_PARTICLES})))) = 0, false) as person from (select full_name, {_TOK} as ts from {_ATT})")
def person_test(t):
    return t("attendance").where("full_name is not null").select("full_name", people.like_person(F.col("full_name")).alias("person")).distinct()


@query("full_name:s shown:s", rf"""select full_name, regexp_replace(trim(regexp_replace('Abgeordneter Frau ' || full_name, '\s+', ' ', 'g')), '(?i)^(?:(?:{"|".join(people.OFFICE_WORDS)})(?:\s+|$))+', '') || ' (LBU)' as shown from {_ATT}""")
def display_names(t):
    x = people.display_name(F.concat(F.lit("Abgeordneter Frau "), "full_name"))
    return t("attendance").where("full_name is not null").select("full_name", people.with_role(x, F.lit("LBU")).alias("shown")).distinct()


def _people(t):
    a = t("attendance").where("surname is not null and full_name is not null")
    g = a.groupBy("stem", F.lower("surname").alias("surname")).agg(F.min(F.lower("full_name")).alias("key"), F.count_distinct(F.lower("full_name")).alias("n_same"))
    return g


_PEO = "(select stem, lower(surname) as surname, min(lower(full_name)) as key, count(distinct lower(full_name)) as n_same from attendance where surname is not null and full_name is not null group by 1, 2)"


def _speech(t):
    """Turns of a sitting: its segments in order, each ending in a hand-off to a person who attends."""
    s = segments(t).where("label is not null and text is not null").withColumn("turn_ix", F.col("pt") * 100000 + F.col("ord"))
    return s.select("stem", "pt", "turn_ix", F.trim("label").alias("label"), "text")


_SPE = f"(select stem, pt, pt * 100000 + ord as turn_ix, trim(label) as label, text from {SEG} where label is not null and text is not null)"
_CUE, _DEFER = (c.replace("(?iU)", "(?i)") for c in (resolve.CUE, resolve.DEFER))
_HAND = f"""(select * from (select *, lead(label) over (partition by stem order by turn_ix) as next_label from {_SPE}) where next_label is not null and next_label <> label and regexp_matches(text, '{_CUE}') and not regexp_matches(text, '{_DEFER}'))"""


@query("stem:s turn_ix:i label:s next_label:s", f"select stem, turn_ix, label, next_label from {_HAND}")
def handoffs(t):
    return resolve.handoffs(_speech(t), ["stem"])


def _known(t):
    """Every surname of one bearer over all sittings, for each sitting: hand-offs name persons of other lists too."""
    p = _people(t).groupBy("surname").agg(F.min("key").alias("key"), F.count_distinct("key").alias("n_same"))
    return p


_VOTES = rf"""(select stem, next_label as label, key, count(*) as votes from (select stem, turn_ix, next_label, arg_max(key, pos) as key from
 (select stem, turn_ix, next_label, unnest(string_split_regex(lower(text), '[^\p{{L}}\p{{N}}_\-]+')) as surname, unnest(range(len(string_split_regex(lower(text), '[^\p{{L}}\p{{N}}_\-]+')))) as pos from {_HAND})
 join (select surname, min(key) as key, count(distinct key) as n_same from {_PEO} group by 1) using (surname) where n_same = 1 and length(surname) >= 3 group by all) group by all)"""


def _votes_by_surname(t):
    return resolve.chair_votes(_speech(t), _known(t), ["stem"])


@query("stem:s label:s key:s votes:i", f"select * from {_VOTES}")
def handoff_votes(t):
    return _votes_by_surname(t)


_WIN = f"(select stem, label, key, votes as score, second is not null as conflict from (select *, row_number() over (partition by stem, label order by votes desc, key) as rn, lead(votes) over (partition by stem, label order by votes desc, key) as second from {_VOTES}) where rn = 1 and (second is null or votes > second))"


@query("stem:s label:s key:s score:d conflict:b", f"select * from {_WIN}")
def vote_winner_conflict(t):
    return resolve.vote_winners(_votes_by_surname(t), ["stem"])


_CC = f"(select stem, label, count(*) as cues, min(turn_ix) as first_ix from (select *, lead(turn_ix) over (partition by stem order by turn_ix) as n from {_SPE}) where n is not null and regexp_matches(text, '{_CUE}') group by all)"


@query("stem:s label:s cues:i", f"select stem, label, cues from {_CC}")
def cue_counts(t):
    return resolve.cue_counts(_speech(t), ["stem"])


@query(
    "stem:s label:s key:s score:d",
    f"""select c.stem, c.label, p.key, c.cues as score from (select *, row_number() over (partition by stem order by cues desc, first_ix) as r from {_CC} where cues >= 2 and (stem, label) not in (select stem, label from {_WIN})) c
    join (select stem, key, row_number() over (partition by stem order by rank) as r from (select stem, lower(full_name) as key, min(mention_id) as rank from attendance where role = 'Vorsitz' and full_name is not null group by 1, 2)
    where (stem, key) not in (select stem, key from {_WIN})) p on c.stem = p.stem and c.r = p.r""",
)
def chair_rank_zip(t):
    chairs = t("attendance").where("role = 'Vorsitz' and full_name is not null").groupBy("stem", F.lower("full_name").alias("key")).agg(F.min("mention_id").alias("rank"))
    return resolve.chair_zip(resolve.cue_counts(_speech(t), ["stem"]), chairs, resolve.vote_winners(_votes_by_surname(t), ["stem"]), ["stem"])


@query("stem:s top:i", f"select distinct stem, pt as top from {_SPE} where len(regexp_extract_all(text, '[.!?]+')) > 1 and (stem, label) not in (select stem, label from {_WIN})")
def unresolved_exclusion(t):
    return resolve.excluded_items(_speech(t).withColumn("top", F.col("pt")), resolve.vote_winners(_votes_by_surname(t), ["stem"]), ["stem"], 1)


@query(
    "stem:s label:s contexts:s",
    f"""select stem, label, array_to_string(list(c order by first), '|') as contexts from (select stem, label, right(before, 300) as c, min(turn_ix) as first from (select *, lag(text) over (partition by stem order by turn_ix) as before, lag(label) over (partition by stem order by turn_ix) as whose from {_SPE}) where whose is not null and whose <> label group by all) group by all""",
)
def handoff_context(t):
    return resolve.handoff_context(_speech(t), ["stem"]).select("stem", "label", F.array_join("contexts", "|").alias("contexts"))


@query("stem:s resolved:i total:i", f"select stem, count(key) as resolved, count(*) as total from (select distinct stem, label from {_SPE}) left join {_WIN} using (stem, label) group by stem")
def speaker_report(t):
    return resolve.session_report(_speech(t), resolve.vote_winners(_votes_by_surname(t), ["stem"]).withColumn("method", F.lit("chair")).select("stem", "label", "key", "method", "score"), ["stem"])


def _minutes(t):
    """Minutes of which the cover names all who attend, with a party, and the body some again, with an office."""
    a = t("attendance").where("full_name is not null").select("stem", F.regexp_replace("full_name", r"\s*\(.*$", "").alias("n"), F.col("role").isNull().alias("b"))
    g = a.groupBy("stem").agg(F.array_sort(F.collect_set("n")).alias("c"), F.array_sort(F.collect_set(F.when(F.col("b"), F.col("n")))).alias("b"))
    with_role = lambda c, r: F.transform(c, lambda x: F.concat(x, F.lit(r)))
    return g.select("stem", F.concat(F.lit("Vorsitz:\n"), F.array_join(with_role("c", " (fraktionslos)"), "\n"), F.lit("\nProtokoll: X")).alias("cover"), F.array_join(with_role("b", " (Ministerium)"), ".\nEs spricht Frau ").alias("body"))


_MIN = """(select stem, 'Vorsitz:' || chr(10) || array_to_string(list_transform(c, lambda x: x || ' (fraktionslos)'), chr(10)) || chr(10) || 'Protokoll: X' as cover, array_to_string(list_transform(b, lambda x: x || ' (Ministerium)'), '.' || chr(10) || 'Es spricht Frau ') as body
 from (select stem, list_sort(list_distinct(list(n))) as c, coalesce(list_sort(list_distinct(list(n) filter (b))), []) as b from (select stem, regexp_replace(full_name, '\\s*\\([^\\n]*$', '') as n, role is null as b from attendance where full_name is not null) group by stem))""".replace("\\\\", "\\")
_UNIT = people.NAME_UNIT.replace("'", "''")
_OFFICES = "|".join(people.OFFICE_WORDS)
_TRIMMED = "|".join([*(x.replace(".", r"\.") for x in people.TITLES), *people.PARTICLES])
_UNITS = {c: f"unnest(regexp_extract_all({c}, '{_UNIT}', 1)) as u, unnest(regexp_extract_all({c}, '{_UNIT}', 2)) as r, unnest(range(len(regexp_extract_all({c}, '{_UNIT}', 1)))) as k" for c in ("cover", "body")}
_PERSON = f"len(ts) between 1 and 5 and regexp_matches(ts[-1], '{_NT}') and len(list_filter(ts, lambda x: not (regexp_matches(x, '{_NT}') or lower(x) in ({_PARTICLES})))) = 0"
_MENTIONS = rf"""(select * from (select stem, src, k, full_name, trim(r) as role, {_TOK} as ts, {_TOK0} as ts0 from (select stem, src, k, r, regexp_replace(trim(regexp_replace(u, '\s+', ' ', 'g')), '(?i)^(?:(?:{_OFFICES})(?:\s+|$))+', '') as full_name from
 (select stem, 0 as src, k, trim(u) as u, r from (select stem, {_UNITS["cover"]} from {_MIN}) where regexp_matches(r, '{people.PARTY}') and not contains(lower(r), 'antrag')
  union all select stem, 1, k, regexp_extract(trim(u), '(?i)((?:(?:{_TRIMMED})\s+)*(?:\S+\s+)?(?:(?:{_TRIMMED})\s+)*\S+)$', 1), r from (select stem, {_UNITS["body"]} from {_MIN}) where regexp_matches(r, '{people.OFFICE.replace("(?iu)", "(?i)")}'))))
 where {_PERSON} and len(ts) >= 2)"""
_GIVEN = "list_filter(list_transform(ts, lambda x: lower(x)), lambda x: x <> lower(ts[-1]))"
_MERGED = f"""(select stem, surname, len(ps) as n_same, unnest(ps) as p from (select stem, surname, list_reduce(list([struct_pack(f := full_name, r := role, g := g)] order by src, k), lambda acc, x:
 case when list_position(list_transform(acc, lambda p: list_has_all(p.g, x[1].g) or list_has_all(x[1].g, p.g)), true) is null then list_concat(acc, x)
 else list_transform(acc, lambda p, i: case when i = list_position(list_transform(acc, lambda p: list_has_all(p.g, x[1].g) or list_has_all(x[1].g, p.g)), true)
  then struct_pack(f := case when length(x[1].f) > length(p.f) then x[1].f else p.f end, r := case when p.r <> '' then p.r else x[1].r end, g := case when length(x[1].f) > length(p.f) then x[1].g else p.g end) else p end) end) as ps
 from (select *, lower(ts[-1]) as surname, {_GIVEN} as g from {_MENTIONS}) group by stem, surname))"""
_DIRECTORY = f"""(select stem, surname, full_name as "full", role, n_same, lower(array_to_string(case when len({_TOK}) > 0 then {_TOK} else {_TOK0} end, ' ')) as key from (select stem, surname, n_same, p.f as full_name, p.r as role from {_MERGED}))"""
_CHAIRS = rf"""(select stem, key, row_number() over (partition by stem order by k) as rank from (select c.stem, d.key, min(c.k) as k from
 (select stem, k, coalesce(lower((case when len({_TOK}) > 0 then {_TOK} else {_TOK0} end)[-1]), '') as surname from (select stem, k, u as full_name, r from (select stem, {_UNITS["cover"]} from {_MIN})) where regexp_matches(r, '{people.PARTY}')) c
 join {_DIRECTORY} d on c.stem = d.stem and c.surname = d.surname and d.n_same = 1 group by 1, 2))"""


def _protocols(t):
    """All different protocols of a sitting as one body, the oldest first."""
    return _together(t, "protocol").withColumnRenamed("text", "body")


@query("stem:s surname:s full:s role:s n_same:i", f"select * from {_DIRECTORY}")
def directory_fold(t):
    return people.directory(people.mentions(_minutes(t), ["stem"]), ["stem"])


@query("stem:s rank:i key:s", f"select * from {_CHAIRS}")
def chair_list(t):
    m = _minutes(t)
    return people.chairs(m, people.directory(people.mentions(m, ["stem"]), ["stem"]), ["stem"])


def _introducing(t):
    """Speech of which every label's first turn names a person who attends: the one whose place in the list is the turn's."""
    s = _speech(t)
    p = _people(t).where("n_same = 1").groupBy("stem").agg(F.array_sort(F.collect_set("surname")).alias("ps"))
    s = s.join(p, "stem", "left").withColumn("who", F.get("ps", (F.col("turn_ix") % F.greatest(F.size("ps"), F.lit(1))).cast("int")))
    return s.withColumn("text", F.when(F.col("who").isNotNull() & (F.col("turn_ix") % 7 == 0), F.concat(F.lit("Mein Name ist "), F.initcap("who"), F.lit(". "), F.col("text"))).otherwise(F.col("text"))).drop("ps", "who")


@query("stem:s label:s key:s method:s score:d")
def resolve_cascade(t):
    m = _minutes(t)
    who = people.directory(people.mentions(m, ["stem"]), ["stem"])
    return resolve.resolved(_introducing(t), who, people.chairs(m, who, ["stem"]), _protocols(t), ["stem"])


_SPI = f"""(select s.stem, pt, turn_ix, label, case when ps is not null and turn_ix % 7 = 0 then 'Mein Name ist ' || upper(left(ps[turn_ix % len(ps) + 1], 1)) || substr(ps[turn_ix % len(ps) + 1], 2) || '. ' || text else text end as text
 from {_SPE} s left join (select stem, list_sort(list_distinct(list(surname))) as ps from {_PEO} where n_same = 1 group by stem) p on s.stem = p.stem)"""
_CAP = r"[A-ZÄÖÜ][\p{L}\p{N}_.\-'']*"
_INTRO = rf"""(select stem, label, arg_min(key, (turn_ix, k)) as key, 'self-intro' as method, 1.0::double as score from (select i.*, p.key from (select stem, label, turn_ix, k, lower((case when len({_TOK}) > 0 then {_TOK} else {_TOK0} end)[-1]) as surname from
 (select stem, label, turn_ix, k, regexp_replace(n, '\.$', '') as full_name from (select stem, label, turn_ix, unnest(regexp_extract_all(text, '(?i:mein name ist|ich heiße|ich heisse|ich bin)\s+({_CAP}(?:\s+(?:{_CAP}|von|van|de|der|zu))*)', 1)) as n,
 unnest(range(len(regexp_extract_all(text, '(?i:mein name ist|ich heiße|ich heisse|ich bin)\s+({_CAP}(?:\s+(?:{_CAP}|von|van|de|der|zu))*)', 1)))) as k from {_SPI}))) i join {_DIRECTORY} p on i.stem = p.stem and i.surname = p.surname and p.n_same = 1) group by stem, label)"""


@query("stem:s label:s key:s method:s score:d", f"select * from {_INTRO}")
def introductions(t):
    m = _minutes(t)
    return resolve.introductions(_introducing(t), people.directory(people.mentions(m, ["stem"]), ["stem"]), ["stem"])


@query("stem:s label:s person:s score:d")
def content_match(t):
    body = _protocols(t)
    none = _speech(t).select("stem", "label", F.lit("x").alias("key")).limit(0)
    return best_assignment(resolve.content_scores(_speech(t), body, _people(t), none, ["stem"]), ["stem"], 20.0)


# ------------------------------------------------------------------ inventory
@query("path:s sitting:i abbr:s date:s part:i dup:i ext:s", f"select distinct path, sitting, abbr, date, part, dup, ext from {PARTS}")
def name_decode(t):
    return inventory.drop_parts(drop_files(t)).select("path", "sitting", "abbr", "date", "part", "dup", "ext").distinct()


_GROUPS = f"""(select abbr, sitting, date, count(*) filter (ext = 'pdf') as n_pdf, count(*) filter (ext = 'mp3') as n_audio, count(*) filter (ext = 'mp3' and dup is not null) as n_dup, count(distinct length) filter (ext = 'pdf') as sizes,
 coalesce(array_to_string(list(path order by coalesce(part, 0), coalesce(dup, 0), path) filter (ext = 'mp3'), '|'), '') as audios from {PARTS} where sitting is not null group by all)"""


@query(
    "abbr:s sitting:i date:s n_pdf:i n_audio:i audios:s flags:s",
    f"""select *, coalesce(nullif(concat_ws(';', case when n_pdf = 0 then 'MISSING_PDF' end, case when n_audio = 0 then 'MISSING_AUDIO' end, case when n_audio > 1 then 'MULTIPART(' || n_audio || ')' end, case when n_dup > 0 then 'DUP_AS_MULTIPART' end,
    case when n_pdf > 1 and sizes = 1 then 'DUP_PDF_SAME' when n_pdf > 1 then 'MULTI_PDF_DIFFER' end), ''), 'OK') as flags from {_GROUPS}""",
)
def import_report(t):
    return inventory.import_flags(inventory.drop_sessions(inventory.drop_parts(drop_files(t)))).withColumn("audios", F.array_join("audios", "|"))


@query("date:s period:s", f"select distinct date, case when substr(date, 1, 4)::int <= 2036 then '1' else '2' end as period from {PARTS} where date is not null")
def period_by_date(t):
    return inventory.drop_parts(drop_files(t)).where("date is not null").select("date", inventory.period_of(F.col("date"), 2036, "1", "2").alias("period")).distinct()


@query(
    "raw_dir:s d_stem:s d_abbr:s d_wp:s d_sitting:i",
    r"""select raw_dir, concat_ws('_', d_abbr, d_wp, coalesce(d_sitting::varchar, 'x')) as d_stem, d_abbr, d_wp, d_sitting from (select raw_dir,
    regexp_replace(case when regexp_matches(ps[1], '\([^)]*\)') then string_split_regex(regexp_extract(ps[1], '\(([^)]*)\)', 1), '[,/;]')[1] else ps[1] end, '\s+', '', 'g') as d_abbr,
    nullif(regexp_extract(list_filter(ps, lambda p: regexp_matches(p, '(?i)^\s*0?(\d{1,2})\s*\.?\s*WP\s*$'))[1], '(?i)^\s*0?(\d{1,2})\s*\.?\s*WP\s*$', 1), '') as d_wp,
    nullif(regexp_extract(regexp_replace(ps[-1], '(?i)^\s*0?\d{1,2}\s*\.?\s*WP\b\.?\s*', ''), '(\d+)', 1), '')::int as d_sitting from (select distinct raw_dir, string_split(raw_dir, '/') as ps from ledger where raw_dir is not null))""",
)
def stem_derive(t):
    return inventory.stem_fields(t("ledger").where("raw_dir is not null").select("raw_dir").distinct())


@query("code:s folder:s", r"select upper(regexp_replace(code, '\s+', '', 'g')) as code, title || ' (' || code || ', ' || code || '2)' as folder from committees union all select upper(code) || '2', title || ' (' || code || ', ' || code || '2)' from committees")
def committee_index(t):
    c = t("committees").select(F.concat("title", F.lit(" ("), "code", F.lit(", "), "code", F.lit("2)")).alias("name"))
    return inventory.committee_index(c)


@query("committee:s pdf_src:s", "select committee, arg_min(pdf_src, (case when lower(n) like '%gesamt%' or lower(n) like '%protokoll%' then '0' when lower(n) like '%anlage%' then '1' else '2' end) || n) as pdf_src from (select committee, pdf_src, string_split(pdf_src, '/')[-1] as n from ledger where lower(pdf_src) like '%.pdf') group by committee")
def pick_protocol(t):
    return inventory.picked_protocol(t("ledger").where("pdf_src is not null").select("committee", F.col("pdf_src").alias("path")).distinct(), ["committee"])


@query("stem:s path:s part_label:s", f"select stem, path, 'pt' || lpad(row_number() over (partition by stem order by coalesce(part, 0), coalesce(dup, 0), path)::varchar, 2, '0') as part_label from {PARTS} where ext = 'mp3'")
def part_numbering(t):
    p = inventory.drop_parts(drop_files(t)).where("ext = 'mp3'")
    return inventory.numbered_parts(p, ["stem"], [F.coalesce("part", F.lit(0)), F.coalesce("dup", F.lit(0)), F.col("path")])


@query("raw_dir:s stem:s collides_with:s", f"select raw_dir, stem, case when row_number() over w > 1 then first_value(raw_dir) over w end as collides_with from (select distinct raw_dir, committee || '_' || coalesce(wp::varchar, '-') as stem from {LED} where raw_dir is not null) window w as (partition by stem order by raw_dir)")
def first_wins_collision(t):
    led = ledger(t).where("raw_dir is not null").select("raw_dir", F.concat("committee", F.lit("_"), F.coalesce(F.col("wp").cast("string"), F.lit("-"))).alias("stem")).distinct()
    return inventory.first_wins(led, "stem", "raw_dir")


@query("stem:s n_audio:i", f"select distinct stem, len(audio_src) as n_audio from {LED} where pdf_src is not null and len(audio_src) > 0")
def trainable_sessions(t):
    return inventory.trainable(ledger(t)).select("stem", F.size("audio_src").alias("n_audio")).distinct()


@query("state:s n:i", f"select state, count(*) as n from {LED} group by 1")
def state_counts(t):
    return ledger(t).groupBy("state").agg(F.count("*").alias("n"))


def _micros(c: str):
    return F.unix_micros(F.col(c).cast("timestamp"))


def _snapshots(t):
    """Two states of the ledger by time: the older knows the sittings seen in the first half, the newer lost those not seen since the first quarter. Each sitting is in at least one."""
    led = ledger(t).groupBy("stem").agg(*[F.min(c).alias(c) for c in ("sitting", "pdf_src", "state", "first_seen")], F.max("last_seen").alias("last_seen"))
    first, last = _micros("first_seen"), F.coalesce(_micros("last_seen"), _micros("first_seen"))
    a, b = led.agg(F.min(first), F.max(first)).first()
    old = first * 2 <= F.lit(a) + F.lit(b)
    new = led.where(~old | (last * 4 >= F.lit(a) * 3 + F.lit(b)))
    new = new.withColumn("pdf_src", F.when(F.col("sitting") % 3 == 0, F.concat(F.coalesce("pdf_src", F.lit("")), F.lit("x"))).otherwise(F.col("pdf_src")))
    return led.where(old), new


_SNAP = f"""(select *, first_us * 2 <= a + b as is_old, first_us * 2 > a + b or last_us * 4 >= a * 3 + b as is_new from (select *, epoch_us(first_seen) as first_us, coalesce(epoch_us(last_seen), epoch_us(first_seen)) as last_us,
 min(epoch_us(first_seen)) over () as a, max(epoch_us(first_seen)) over () as b from
 (select stem, min(sitting) as sitting, min(pdf_src) as pdf_src, min(state) as state, min(first_seen) as first_seen, max(last_seen) as last_seen from {LED} group by stem)))"""
_DIFF = f"""(select coalesce(n.stem, o.stem) as stem, case when o.stem is null then 'NEW' when n.stem is null then 'MISSING' when o.pdf_src is not distinct from n.pdf_src and o.state is not distinct from n.state then 'UNCHANGED' else 'CHANGED' end as state,
 epoch_us(coalesce(o.first_seen, n.first_seen)) as first_seen, epoch_us(case when n.stem is null then o.last_seen else n.last_seen end) as last_seen
 from (select * from {_SNAP} where is_old) o full join (select stem, state, first_seen, last_seen, case when sitting % 3 = 0 then coalesce(pdf_src, '') || 'x' else pdf_src end as pdf_src from {_SNAP} where is_new) n on o.stem = n.stem)"""


@query("stem:s state:s first_seen:i last_seen:i", f"select * from {_DIFF}")
def ledger_diff(t):
    d = inventory.ledger_diff(*_snapshots(t), ["pdf_src", "state"])
    return d.select("stem", "state", _micros("first_seen").alias("first_seen"), _micros("last_seen").alias("last_seen"))


@query("stem:s", f"select stem from {_DIFF} where state in ('NEW', 'CHANGED')")
def delta_manifest(t):
    return inventory.ledger_diff(*_snapshots(t), ["pdf_src", "state"]).where("state in ('NEW', 'CHANGED')").select("stem")


@query("stem:s", f"select stem from {_DIFF} where state <> 'MISSING'")
def pruned_ledger(t):
    return inventory.ledger_diff(*_snapshots(t), ["pdf_src", "state"], prune=True).select("stem")


@query(
    "stem:s wp:s sitting:s n_pdf:i n_audio:i flags:s pdf_src:s audio_src:s",
    f"""select stem, coalesce(wp::varchar, '-') as wp, coalesce(sitting::varchar, '-') as sitting, (pdf_src is not null)::int as n_pdf, len(coalesce(audio_src, [])) as n_audio,
    coalesce(nullif(concat_ws(';', case when sitting is null then 'NO_SITTING_NUM' end, case when pdf_src is null then 'MISSING_PDF' end, case when len(coalesce(audio_src, [])) = 0 then 'MISSING_AUDIO' end, case when len(audio_src) > 1 then 'MULTIPART(' || len(audio_src) || ')' end), ''), 'OK') as flags,
    coalesce(pdf_src, '-') as pdf_src, coalesce(nullif(array_to_string(audio_src, ';'), ''), '-') as audio_src from {LED}""",
)
def ingest_report(t):
    return inventory.ingest_report(ledger(t).withColumn("collides_with", F.lit(None).cast("string")))


@query("stem:s shard:i", f"select stem, (row_number() over (order by stem) - 1) % 5 as shard from (select distinct stem from {LED})")
def shard_assign(t):
    return inventory.shards(ledger(t).select("stem").distinct(), "stem", 5)


@query(
    "stem:s kind:s part:i src_path:s status:s",
    f"""select *, case when kind = 'audio' then 'linked' when length(src_path) % 3 = 1 then 'exists' when length(src_path) % 3 = 2 then 'EXISTS_DIFFERS' else 'linked' end as status
    from (select distinct stem, 'pdf' as kind, 0 as part, pdf_src as src_path from {LED} where pdf_src is not null union all select distinct stem, 'audio', unnest(range(len(audio_src)))::int, unnest(audio_src) from {LED})""",
)
def staging_plan(t):
    """The minutes of some sittings are staged already, of some from another file."""
    led = ledger(t).select("stem", "pdf_src", "audio_src").distinct()
    have = led.where("length(pdf_src) % 3 > 0").select("stem", F.lit("pdf").alias("kind"), F.lit(0).alias("part"), F.when(F.length("pdf_src") % 3 == 1, F.col("pdf_src")).otherwise(F.concat("pdf_src", F.lit(".alt"))).alias("src_path")).distinct()
    return sinks.staged(led, have).distinct()


@query("dst_path:s status:s", f"select path as dst_path, case length % 3 when 0 then 'copied' when 1 then 'exists' else 'EXISTS_DIFFERS' end as status from (select distinct path, length from {FILES})")
def copy_plan(t):
    """Files of which some are there in the same size, some in another."""
    f = drop_files(t).select(F.col("path").alias("dst_path"), "length").distinct()
    return sinks.copied(f, f.where("length % 3 > 0").withColumn("length", F.when(F.col("length") % 3 == 1, F.col("length")).otherwise(F.col("length") + 1)))


# ------------------------------------------------------------------ providers and stream
@query("rec_id:i seq_tokens:i", f"""select rec_id, ceil(length("user") / 4.0) as seq_tokens from {REC}""")
def token_count_provider(t):
    return providers.counted(records(t).select("rec_id", "user"), "user").select("rec_id", "seq_tokens")


@query("stem:s first_seen:s last_seen:s n:i", "select stem, strftime(min(first_seen), '%Y-%m-%d %H:%M:%S') as first_seen, strftime(max(first_seen), '%Y-%m-%d %H:%M:%S') as last_seen, count(*) as n from ledger where stem is not null group by 1")
def stream_ledger(t):
    batch = t("ledger")
    spark, path = batch.sparkSession, batch.inputFiles()[0].rsplit("/", 1)[0]
    root = spark.conf.get("spark.checkpoint.dir", None) or "file://" + tempfile.mkdtemp(prefix="redewerk-")
    import uuid

    at = f"{root}/ledger-{uuid.uuid4().hex}"
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in batch.schema.fields)
    table = sinks.VersionedTable(spark, f"{at}/table")
    q = arrivals.keep_ledger(arrivals.arrivals(spark, path, schema, "ledger.parquet" if not path.endswith("ledger.parquet") else "*.parquet").select("stem", F.col("first_seen").alias("seen")), table, f"{at}/progress")
    q.awaitTermination()
    return table.read(arrivals.LEDGER).select("stem", F.date_format("first_seen", "yyyy-MM-dd HH:mm:ss").alias("first_seen"), F.date_format("last_seen", "yyyy-MM-dd HH:mm:ss").alias("last_seen"), "n")
