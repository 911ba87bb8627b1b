"""Queries of whole stages: pairing, dataset build, tiers of speaker resolution, agenda placement, reports; each with the SQL that must give the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import agenda, dataset, pairing, people, providers, quality, resolve
from . import queries as Q
from .build import Options, build
from .queries import query

# ------------------------------------------------------------------ pairing
# Similarity by the longest common subsequence, folded over the characters of one name
_SORTED = r"array_to_string(list_sort(list_filter(string_split_regex(lower({0}), '\s+'), lambda w: w <> '')), ' ')"
_LCS = """list_reduce(list_prepend(list_transform(range(length({b})), lambda j: 0), list_transform(range(1, length({a}) + 1), lambda i: list_transform(range(1, length({b}) + 1), lambda j: ({a}[i] = {b}[j])::int))),
 lambda prev, eq: list_transform(range(1, len(eq) + 1), lambda j: list_max(list_transform(range(1, j + 1), lambda i: greatest(prev[i], coalesce(prev[i - 1], 0) + eq[i])))))[-1]"""
_KEYED = {x: f"(select distinct stem as name, {Q.CANON.format('stem')} as key, {_SORTED.format(Q.CANON.format('stem'))} as sorted from {x} where stem is not null)" for x in ("ledger", "manifest")}
_SAME = f"""(select l.name, r.name as partner from (select *, row_number() over (partition by key order by name) as n from {_KEYED["ledger"]}) l join (select *, row_number() over (partition by key order by name) as n from {_KEYED["manifest"]}) r using (key, n))"""


@query(
    "name:s partner:s score:d",
    f"""with l as {_KEYED["ledger"]}, r as {_KEYED["manifest"]}, same as {_SAME},
    c as (select l.name, r.name as partner, 100.0 * 2 * {_LCS.format(a="l.sorted", b="r.sorted")} / (length(l.sorted) + length(r.sorted)) as score from (select * from l where name not in (select name from same)) l join (select * from r where name not in (select partner from same)) r
      on split_part(l.key, ' ', 1) = split_part(r.key, ' ', 1) and regexp_extract_all(l.key, '\\d+') = regexp_extract_all(r.key, '\\d+')),
    f as (select list_reduce(list_prepend([]::struct(l varchar, r varchar, s double)[], list([struct_pack(l := name, r := partner, s := score)] order by name, score desc, partner)), lambda acc, x:
      case when list_contains(list_transform(acc, lambda p: p.l), x[1].l) or list_contains(list_transform(acc, lambda p: p.r), x[1].r) then acc else list_concat(acc, x) end) as ps from c where score >= 90)
    select name, partner, 100.0 as score from same union all select p.l, p.r, p.s from (select unnest(ps) as p from f)""",
)
def fuzzy_pairing(t):
    led, man = Q.ledger(t), t("manifest").where("stem is not null").select("stem").distinct()
    side = lambda d: d.where("stem is not null").select(F.col("stem").alias("name"), X.canonical_key(F.col("stem")).alias("key")).distinct().withColumn("block", F.substring_index("key", " ", 1))
    return pairing.fuzzy_pairs(side(led), side(man))


@query("name:s partner:s", f"select l.name, r.partner from {_KEYED["ledger"]} l left join (select key, max(name) as partner from {_KEYED["manifest"]} group by key) r using (key)")
def exact_pairing(t):
    side = lambda d: d.where("stem is not null").select(F.col("stem").alias("name"), X.canonical_key(F.col("stem")).alias("key")).distinct()
    return pairing.exact_pairs(side(Q.ledger(t)), side(t("manifest"))).select("name", "partner")


# ------------------------------------------------------------------ dataset build
_EVERY = 40  # segments of an agenda item in the tagged transcripts below


def _tagged(t):
    """(stem, text): a sitting's segments of all parts in markup, with an agenda tag at every fortieth."""
    s = Q.segments(t).withColumn("text", F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"[^\p{L}\p{N} ]", ""))).withColumn("label", F.trim(F.coalesce("label", F.lit("SPEAKER_99"))))
    g = s.groupBy("stem").agg(F.array_sort(F.collect_list(F.struct("pt", "ord", "label", "text"))).alias("x"))
    tag = lambda i: F.when(i % _EVERY == 0, F.concat(F.lit("<SD-TOP>TOP "), (F.floor(i / _EVERY) + 1).cast("string"), F.lit("</SD>\n"))).otherwise(F.lit(""))
    block = lambda x, i: F.concat(tag(i), F.lit("<SD-SPK>"), x["label"], F.lit("</SD>\n[00:00:01.000 --> 00:00:02.000] "), x["text"])
    return g.select("stem", F.array_join(F.transform("x", block), "\n\n").alias("text"))


def _built(t, **more):
    m = Q._together(t, "protocol").select("stem", F.concat(F.lit("Deckblatt\n\n## Beschlüsse und Festlegungen\n\n"), "text").alias("text"))
    ex = m.where(F.length("stem") % 2 == 0).select("stem", F.lit(2).alias("top"))
    return build(_tagged(t), m, t("manifest"), ex, Options(**more))


_O = Options()
_MIN = f"(select stem, {Q.CANON.format('stem')} as k, stem as doc_id, '## Beschlüsse und Festlegungen' || chr(10) || chr(10) || text as x from {Q._TWO.format('protocol')} where {Q.CANON.format('stem')} not in (select {Q.CANON.format('stem')} from manifest where stem is not null))"
_BODY = "(select m.stem, m.k, c.body from " + _MIN + " m join " + Q.clean_sql(_MIN) + " c using (doc_id))"
_TX = f"""(select *, {Q.CANON.format('stem')} as k, (rn - 1) // {_EVERY} + 1 as top from (select stem, trim(coalesce(label, 'SPEAKER_99')) as label, trim(regexp_replace(coalesce(text, ''), '[^\\p{{L}}\\p{{N}} ]', '', 'g')) as text, row_number() over (partition by stem order by pt, ord) as rn from {Q.SEG})
 where {Q.CANON.format('stem')} not in (select {Q.CANON.format('stem')} from manifest where stem is not null))"""
_PAIR = f"(select t.stem, t.k, m.body from (select distinct stem, k from {_TX}) t join {_BODY} m on t.k = m.k)"
_SRC = f"""(select stem, top, string_agg(line, chr(10) order by island) as rendered from (select stem, top, island, min(label) || ': ' || string_agg(text, ' ' order by rn) as line from
 (select *, sum(case when label is distinct from b then 1 else 0 end) over (partition by stem, top order by rn) as island from (select *, lag(label) over (partition by stem, top order by rn) as b from {_TX} where text <> '')) group by all) group by stem, top)"""
_TGT = "(select stem, top, rtrim('## Zu TOP ' || top || ':' || case when title <> '' then ' ' || title else '' end) || case when body <> '' then chr(10) || chr(10) || body else '' end as target from " + Q._PARTS.replace("{0}", "(select * from " + Q._SECT.format(k="stem", c="body", t=_PAIR) + ")") + ")"
_ITEM = rf"""(select s.stem, s.top, target, '{Q._FRAME[0]}' || coalesce(nullif(trim(regexp_replace(regexp_extract(p.body, '(?im)^#*\s*Zu\s+TOP\s*' || s.top || '\s+(.+)$', 1), '\s+', ' ', 'g'), ' :-–'), ''), 'TOP ' || s.top) || '{Q._FRAME[1]}' || coalesce(rendered, '') || '{Q._FRAME[2]}' as user_
 from (select distinct stem, top from {_TX}) s left join {_SRC} r on s.stem = r.stem and s.top = r.top join {_TGT} g on s.stem = g.stem and s.top = g.top join {_PAIR} p on p.stem = s.stem)"""
_ROWS = f"""(select *, case when length(stem) % 2 = 0 and top = 2 then 'speaker-excluded' when n_words < {_O.min_words} then 'short-target' when seq_tokens > {_O.cap} then 'over-cap' end as reason, own = 'val' and seq_tokens > {_O.val_cap} as overflow from
 (select *, len({Q.WORDS.format("target")}) as n_words, length('{_O.system}' || chr(10) || user_ || chr(10) || target) // 4 as seq_tokens, case when {Q.PIN.format(Q.CANON.format("stem"))} < 1000 then 'val' else 'train' end as own from {_ITEM}))"""
_UNTAGGED = f"(select distinct stem from {_PAIR} where stem not in (select stem from {_ITEM}))"


@query("stem:s top:i split:s user:s target:s src_tokens:i tgt_tokens:i seq_tokens:i", f"select stem, top, case when overflow then 'train' else own end as split, user_ as \"user\", target, len({Q.WORDS.format('user_')}) as src_tokens, n_words as tgt_tokens, seq_tokens from {_ROWS} where reason is null")
def build_records(t):
    """The dataset build over all transcripts and minutes."""
    r = _built(t).records
    return r.select("stem", "top", "split", F.col("messages")[1]["content"].alias("user"), F.col("messages")[2]["content"].alias("target"), "meta.src_tokens", "meta.tgt_tokens", "meta.seq_tokens")


_REJECTED = f"""(select stem, top::varchar as top, coalesce(reason, 'val-overflow') as reason, seq_tokens::varchar as seq_tokens, case when reason is null then 'rerouted' else 'dropped' end as disposition from {_ROWS} where reason is not null or overflow
 union all select stem, '*', 'no-aligned-tops', '-', 'dropped' from {_UNTAGGED})"""


@query("stem:s top:s reason:s seq_tokens:s disposition:s", f"select * from {_REJECTED}")
def build_rejects(t):
    return _built(t).rejects


@query("place:i stem:s reason:s", f"select row_number() over (order by list_position({dataset.REASONS!r}, reason), stem, top) - 1 as place, stem, reason from {_REJECTED}")
def build_reject_order(t):
    """The reject ledger in its order, by place."""
    from ..operators.inventory import positions

    r = _built(t).rejects.withColumn("rank", F.array_position(F.array(*[F.lit(x) for x in dataset.REASONS]), F.col("reason")))
    return positions(r, ["rank", "stem", "top"]).select(F.col("position").alias("place"), "stem", "reason")


@query(
    "split:s sessions:i records:i tgt_tokens_min:i tgt_tokens_median:i seq_tokens_max:i",
    f"""select split, count(distinct stem) as sessions, count(*) as records, min(n_words) as tgt_tokens_min, list_sort(list(n_words))[(count(*) // 2 + 1)::int] as tgt_tokens_median, max(seq_tokens) as seq_tokens_max
    from (select *, case when overflow then 'train' else own end as split from {_ROWS} where reason is null) group by split""",
)
def build_summary(t):
    return _built(t).summary


@query("stem:s strategy:s n:i", f"""select stem, 'per-top' as strategy, count(*) as n from {_ROWS} where reason is null group by 1 union all select p.stem, 'document-fallback', 1 from {_PAIR} p where p.stem in (select stem from {_UNTAGGED}) and len({Q.WORDS.format('p.body')}) >= {_O.min_words}""")
def build_with_documents(t):
    """The build with sittings without an aligned item as whole documents."""
    return _built(t, include_untagged=True).records.groupBy("stem", F.col("meta.strategy").alias("strategy")).agg(F.count("*").alias("n"))


@query("stem:s top:s reason:s disposition:s", f"select stem, top, reason, disposition from {_REJECTED} where reason <> 'no-aligned-tops' union all select stem, '*', 'no-aligned-tops', 'recovered' from {_UNTAGGED}")
def build_report_with_documents(t):
    """The whole report of a build in which sittings without an aligned item become documents; documents too short are rejects of their own."""
    b = _built(t, include_untagged=True)
    return b.rejects.where("top <> 'document'").unionByName(b.recovered).select("stem", "top", "reason", "disposition")


# ------------------------------------------------------------------ resolution
_W1 = Q._INTRO
_HAND = Q._HAND.replace(Q._SPE, Q._SPI)
_V = Q._VOTES.replace(Q._HAND, _HAND).replace(f"(select surname, min(key) as key, count(distinct key) as n_same from {Q._PEO} group by 1) using (surname)", f"{Q._DIRECTORY} using (stem, surname)")
_W2 = f"(select * from (select stem, label, key, 'chair' as method, votes::double as score from (select *, row_number() over (partition by stem, label order by votes desc, key) as rn, lead(votes) over (partition by stem, label order by votes desc, key) as second from {_V}) where rn = 1 and (second is null or votes > second)) where (stem, label) not in (select stem, label from {_W1}))"
_W12 = f"(select stem, label, key, method, score from {_W1} union all select * from {_W2})"
_W3 = f"""(select c.stem, c.label, p.key, 'chair-vorsitz' as method, c.cues::double as score from (select *, row_number() over (partition by stem order by cues desc, first_ix) as r from {Q._CC.replace(Q._SPE, Q._SPI)} where cues >= 2 and (stem, label) not in (select stem, label from {_W12})) c
 join (select stem, key, row_number() over (partition by stem order by rank) as r from {Q._CHAIRS} where (stem, key) not in (select stem, key from {_W12})) p on c.stem = p.stem and c.r = p.r)"""
_W123 = f"(select * from {_W12} union all select * from {_W3})"


def _rules(t):
    m = Q._minutes(t)
    who = people.directory(people.mentions(m, ["stem"]), ["stem"])
    speech = Q._introducing(t)
    return speech, who, resolve.resolved(speech, who, people.chairs(m, who, ["stem"]), None, ["stem"])


@query("stem:s label:s key:s method:s score:d", f"select * from {_W123}")
def resolve_rules(t):
    """The tiers of the cascade that are rules, one after the other."""
    return _rules(t)[2]


_OPEN = f"(select stem, label, row_number() over (partition by stem order by label) as i from (select distinct stem, label from {Q._SPI} where trim(coalesce(text, '')) <> '' and (stem, label) not in (select stem, label from {_W123})))"


def _answers(t, speech, who, done):
    """A table of answers as a model would give them: the i-th open label is the i-th free person, every third not for certain, every fifth somebody new."""
    from pyspark.sql import Window as W

    prompts = resolve.transcript_prompts(speech, done, ["stem"]).select("stem", X.prompt_hash(F.col("prompt")).alias("prompt_hash"))
    i = F.row_number().over(W.partitionBy("stem").orderBy("label"))
    labels = speech.where("trim(coalesce(text, '')) <> ''").select("stem", "label").distinct().join(done.select("stem", "label"), ["stem", "label"], "left_anti").withColumn("i", i)
    free = who.select("stem", "key", "full").join(done.select("stem", "key"), ["stem", "key"], "left_anti").groupBy("stem", "key").agg(F.min("full").alias("full")).withColumn("i", F.row_number().over(W.partitionBy("stem").orderBy("key")))
    name = F.when(F.col("i") % 5 == 4, F.concat(F.lit("Gast Nummer"), F.col("i").cast("string"))).otherwise(F.col("full"))
    entry = F.struct("label", F.struct(name.alias("name"), F.when(F.col("i") % 3 == 0, "unsure").otherwise("certain").alias("confidence")).alias("x"))
    g = labels.join(free, ["stem", "i"], "left").groupBy("stem").agg(F.to_json(F.map_from_entries(F.collect_list(entry))).alias("response"))
    return prompts.join(g, "stem").select("prompt_hash", F.concat(F.lit("Antwort: "), "response").alias("response"))


@query(
    "stem:s label:s key:s method:s",
    f"""select o.stem, o.label, case when o.i % 5 = 4 then 'gast nummer' || o.i else p.key end as key, 'transcript-llm' as method from {_OPEN} o
    left join (select stem, key, row_number() over (partition by stem order by key) as i from (select distinct stem, key from {Q._DIRECTORY} where (stem, key) not in (select stem, key from {_W123}))) p on o.stem = p.stem and o.i = p.i
    where o.i % 3 <> 0 and (o.i % 5 = 4 or p.key is not null)""",
)
def transcript_tier(t):
    """Labels named for certain by a table of answers, snapped to the directory or new."""
    speech, who, done = _rules(t)
    done = done.select("stem", "label", "key")
    return resolve.transcript_tier(speech, who, done, _answers(t, speech, who, done), ["stem"]).select("stem", "label", "key", "method")


@query("stem:s label:s key:s method:s")
def protocol_tier(t):
    """Labels named item by item by a model that takes labels and free persons in order."""
    speech, who, done = _rules(t)
    minutes = Q.sections.minutes_sections(Q._together(t, "protocol"), ["stem"])
    return resolve.protocol_tier(speech.withColumn("top", F.col("pt")), minutes, who, done.select("stem", "label", "key"), ["stem"], providers.InOrder).select("stem", "label", "key", "method")


# ------------------------------------------------------------------ agenda placement
_ITEMS = [(n, "Beratung") for n in range(1, 7)]
_BUDGET = 300
_BASE = len(agenda.placement_prompt(_ITEMS, {}, [])) // 4
_SAID = f"(select stem, pt, ord, 'Wir kommen zu TOP ' || (ord % 9 + 1) || '. ' || coalesce(text, '') as text from {Q.SEG})"
_WIN = Q.budget_sql(_SAID, "stem, pt", "ord", "length(left(text, 300)) // 4 + 8", _BUDGET, _BASE)
_PLACED = f"""(select stem, pt, p.n as top, p.i as turn_ix from (select stem, pt, unnest(list_reduce(list_prepend([]::struct(n bigint, i bigint)[], list([struct_pack(n := n::bigint, i := i::bigint)] order by w, n)), lambda acc, x:
 case when list_contains(list_transform(acc, lambda p: p.n), x[1].n) or x[1].i < coalesce(acc[-1].i, 0) then acc else list_concat(acc, x) end)) as p
 from (select stem, pt, "window" as w, ord % 9 + 1 as n, min(ord) as i from {_WIN} where ord % 9 < 6 group by all) group by stem, pt))"""


def _turns(t):
    text = F.concat(F.lit("Wir kommen zu TOP "), (F.col("ord") % 9 + 1).cast("string"), F.lit(". "), F.coalesce("text", F.lit("")))
    return Q.segments(t).select("stem", "pt", F.col("ord").alias("turn_ix"), F.coalesce("label", F.lit("-")).alias("label"), text.alias("text"))


def _placed(t):
    turns = _turns(t)
    items = turns.select("stem", "pt").distinct().select("stem", "pt", F.explode(F.array(*[F.struct(F.lit(n).alias("top"), F.lit(x).alias("title")) for n, x in _ITEMS])).alias("x")).select("stem", "pt", "x.*")
    anchors = items.select("stem", "pt", "top", F.lit("").alias("section")).limit(0)
    return turns, items, agenda.placed_by_model(turns, items, anchors, ["stem", "pt"], providers.Announced, _BUDGET)


@query("stem:s pt:i top:i turn_ix:i", f"select * from {_PLACED}")
def model_placement(t):
    """Agenda items placed window by window by a model that finds them where they are named."""
    return _placed(t)[2]


_OPENING = f"(select * from (select *, row_number() over (partition by stem, pt order by turn_ix, top) as rn from {_PLACED}))"
_CUTS = f"(select distinct stem, pt, turn_ix from {_OPENING} where rn > 1 and turn_ix % 2 = 0)"


@query("stem:s pt:i top:i turn_ix:i", f"select p.stem, p.pt, top, p.turn_ix + (select count(*) from {_CUTS} c where c.stem = p.stem and c.pt = p.pt and c.turn_ix <= p.turn_ix) as turn_ix from {_PLACED} p")
def boundary_split(t):
    """Turns that close an item before they open the next are cut; the items move on."""
    turns, _, tops = _placed(t)
    lines = F.when(F.col("turn_ix") % 2 == 0, F.array(F.lit("Damit ist der Antrag angenommen."), F.col("text"))).otherwise(F.array(F.col("text"), F.lit("Danke.")))
    turns = turns.withColumn("lines", lines).withColumn("text", F.when(F.col("turn_ix") % 2 == 0, F.array_join(lines, " ")).otherwise(F.lit("Danke.")))
    cuts = agenda.boundary_cuts(turns, tops, ["stem", "pt"], providers.LastClose)
    return agenda.moved_tops(tops, cuts, ["stem", "pt"])


@query(
    "stem:s pt:i cover_only:s transcript_tops:s titles:i method:s",
    f"""select s.stem, s.pt, array_to_string(list_filter([1, 2, 3, 4, 5, 6], lambda n: not list_contains(coalesce(tops, []), n)), ',') as cover_only, coalesce(array_to_string(tops, ','), '') as transcript_tops, 6 as titles, 'llm' as method
    from (select distinct stem, pt from {Q.SEG}) s left join (select stem, pt, list_sort(list(top)) as tops from {_PLACED} group by stem, pt) p on s.stem = p.stem and s.pt = p.pt""",
)
def agenda_tag_report(t):
    _, items, tops = _placed(t)
    r = agenda.tag_report(items, tops, ["stem", "pt"], "llm")
    return r.select("stem", "pt", F.array_join("cover_only", ",").alias("cover_only"), F.array_join("transcript_tops", ",").alias("transcript_tops"), F.size("agenda_titles").alias("titles"), "method")


# ------------------------------------------------------------------ summaries, evaluation, held-out list
@query(
    "stem:s summary:s",
    rf"""select stem, '## Zu TOP 1' || chr(10) || chr(10) || array_to_string(string_split(regexp_replace(trim(text, ' ' || chr(10) || chr(9) || chr(13)), '([.!?])\s+', '\1' || chr(1), 'g'), chr(1))[1:2], ' ') as summary
    from (select stem, string_agg(text, ' ' order by pt, ord) as text from {Q.SEG} where text is not null group by stem)""",
)
def summarise_stub(t):
    s = Q.segments(t).where("text is not null").groupBy("stem").agg(F.array_sort(F.collect_list(F.struct("pt", "ord", "text"))).alias("x"))
    s = s.select("stem", F.lit(1).alias("top"), F.lit("Beratung").alias("title"), F.array_join(F.transform("x", lambda x: x["text"]), " ").alias("text"))
    return providers.summarised(s, "System")


@query(
    "example:s words:i gold_words:i ratio:d degenerate:b",
    f"""select m.doc_id::varchar as example, words, coalesce(nullif(g, 0), 1) as gold_words, round(words::double / coalesce(nullif(g, 0), 1), 2) as ratio, timestamp_leaks > 0 or tag_leaks > 0 or coalesce(max_repeat, 0) >= 3 or gibberish * 10 >= greatest(words, 1) as degenerate
    from {Q._MET} m left join {Q._RUN} r using (doc_id) left join (select doc_id, words // 2 as g from {Q._MET} where doc_id % 3 <> 0) using (doc_id)""",
)
def evaluation_table(t):
    """All documents as outputs against gold of half their words; some have none."""
    d = t("documents").where("text is not null")
    gold = d.where("doc_id % 3 <> 0").select(F.col("doc_id").cast("string").alias("example"), F.floor(X.word_count(F.col("text")) / 2).alias("words"))
    return quality.comparison(d.select(F.col("doc_id").cast("string").alias("example"), "text"), gold, ["example"])


@query("text:s", "select '| split | n |' || chr(10) || '|---|---|' || chr(10) || string_agg('| ' || coalesce(split, '-') || ' | ' || n || ' |', chr(10) order by n, split nulls first) as text from (select split, count(*) as n from (select distinct on (rec_id) split from records) group by split)")
def markdown_report(t):
    r = Q.records(t).groupBy("split").agg(F.count("*").alias("n"))
    return quality.markdown_table(r, ["split", "n"], ["n", "split"])


_NOTE = "held out of every training split"


@query(
    "example:s stem:s source:s tops:i speakers:i invented_speakers:i transcript_words:i gold_words:i split_note:s",
    rf"""select 'ex_' || stem as example, stem, 'archiv' as source, len(regexp_extract_all(x, '<SD-TOP>')) as tops, len(list_distinct(regexp_extract_all(x, '<SD-SPK>([^<]*)</SD>', 1))) as speakers, len(list_distinct(regexp_extract_all(x, 'SPEAKER_\d+'))) as invented_speakers,
    len({Q.WORDS.format('x')}) as transcript_words, len({Q.WORDS.format('y')}) as gold_words, '{_NOTE}' as split_note
    from (select stem, string_agg(case when (rn - 1) % {_EVERY} = 0 then '<SD-TOP>TOP ' || top || '</SD>' || chr(10) else '' end || '<SD-SPK>' || label || '</SD>' || chr(10) || '[00:00:01.000 --> 00:00:02.000] ' || text, chr(10) || chr(10) order by rn) as x from {_TX} group by stem)
    join (select stem, text as y from {Q._TWO.format('protocol')}) using (stem) where contains('ex_' || stem, '_1_')""",
)
def held_out_list(t):
    """The list of the test set for all sittings with minutes whose example name holds ``_1_``."""
    tx = dataset.held_out(_tagged(t), t("manifest")).withColumnRenamed("text", "transcript")
    m = Q._together(t, "protocol").withColumnRenamed("text", "minutes")
    e = tx.join(m, "stem").select(F.concat(F.lit("ex_"), "stem").alias("example"), "stem", F.lit("archiv").alias("source"), "transcript", "minutes")
    return dataset.held_out_manifest(dataset.only(e, "_1_"), _NOTE)
