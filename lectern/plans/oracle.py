"""SQL for the queries, for DuckDB over the same tables."""

from __future__ import annotations

from ..functions import text as tx
from ..operators import acquisition

S = tx.SPACE


def words(text: str) -> str:
    return f"list_filter(regexp_split_to_array(coalesce({text}, ''), '[{S}]+'), lambda w: w <> '')"


def strip(text: str) -> str:
    return f"regexp_replace({text}, '^[{S}]+|[{S}]+$', '', 'g')"


def repetition(w: str) -> str:
    grams = f"list_transform(range(1, cast(len({w}) as bigint) - 2), lambda i: array_to_string({w}[i:i + 3], ' '))"
    return f"case when len({w}) >= 4 then 1.0::double - len(list_distinct({grams}))::double / (len({w}) - 3)::double else 0.0::double end"


def normalised(text: str) -> str:
    bare = rf"regexp_replace(lower(coalesce({text}, '')), '\p{{P}}', '', 'g')"
    return strip(f"regexp_replace({bare}, '[{S}][{S}]+', ' ', 'g')")


def sentence(text: str) -> str:
    return rf"coalesce(nullif(regexp_extract({text}, '(?s)^(.*?[.!?])[{S}]', 1), ''), {text})"


def topic(text: str) -> str:
    clean = strip(f"coalesce({text}, '')")
    first = sentence(clean)
    return f"case when {clean} = '' then '{tx.NO_SPEECH}' when len({words(first)}) > {tx.TOPIC_WORDS} then array_to_string({words(first)}[1:{tx.TOPIC_WORDS}], ' ') || '...' else {first} end"


def decile(a: str, i: int) -> str:
    n = f"len({a})"
    j = f"greatest(1, least({i} * ({n} + 1) // 10, {n} - 1))"
    d = f"({i} * ({n} + 1) - 10 * {j})"
    return f"case when {n} < 2 then {a}[1] else ({a}[{j}] * (10 - {d}) + {a}[{j} + 1] * {d}) / 10 end"


DOC_QUALITY = f"""
w as (select doc_id, n_chars / 15.0::double as duration, {words('text')} as w from documents),
m as (select doc_id, duration, cast(len(w) as integer) as word_count, case when duration > 0 then len(w) / duration else 0.0 end as words_per_second, {repetition('w')} as repetition_score from w),
q as (select *, list_filter([case when words_per_second > 0 and words_per_second < 1.0 then 'implausibly_slow' end, case when words_per_second > 4.5 then 'implausibly_fast' end,
  case when repetition_score > 0.3 then 'possible_repetition_hallucination' end, case when word_count = 0 then 'empty_transcript' end], lambda x: x is not null) as flags from m)"""

STATS = f"""
l as (unpivot (select duration, word_count::double as word_count, words_per_second, repetition_score from q) on duration, word_count, words_per_second, repetition_score into name metric value v),
a as (select metric, avg(v) as mean, median(v) as median, min(v) as min, max(v) as max, list_sort(list(v)) as a from l group by metric),
s as (select metric, mean, median, min, max, {decile('a', 1)} as p10, {decile('a', 9)} as p90 from a)"""

ROLES = f"""
t as (select conv_id, turn, role as speaker, text, cast(len({words('text')}) as double) as seconds from conversations),
st as (select conv_id, speaker, sum(seconds) as total_seconds, count(*) as turn_count, min(turn) as first_pos from t group by all),
ch as (select conv_id, speaker as target_speaker from st qualify row_number() over (partition by conv_id order by total_seconds desc, first_pos, speaker) = 1)"""

ROLE_SEGMENTS = f"""{ROLES},
i as (select t.*, speaker = target_speaker as hit, sum(case when speaker = target_speaker then 0 else 1 end) over (partition by conv_id order by turn) as island from t join ch using (conv_id)),
g as (select conv_id, island, min(turn) as start, max(turn) as "end", {strip("string_agg(text, ' ' order by turn)")} as text from i where hit group by conv_id, island),
sg as (select conv_id, cast(row_number() over (partition by conv_id order by island) - 1 as integer) as id, start, "end", text from g)"""

EVENTS = """
e0 as (select user_id, event_id, event_type as speaker, value, epoch_us(ts) as us from events),
e1 as (select *, min(us) over (partition by user_id) as first, row_number() over (partition by user_id order by us, event_id) - 1 as pos, lead(us) over (partition by user_id order by us, event_id) as nxt from e0),
e as (select user_id, pos, speaker, value, (us - first)::double / 1e6 as start, (us - first)::double / 1e6 + floor(value * 60) as "end", (coalesce(nxt, us) - first)::double / 1e6 as turn_end from e1)"""

ALIGNED = f"""{EVENTS},
sp as (select user_id, speaker, sum(turn_end - start) as total, count(*) as turn_count, min(start) as first_pos from e group by all),
tg as (select user_id, speaker as target_speaker, total, turn_count from sp qualify row_number() over (partition by user_id order by total desc, first_pos, speaker) = 1),
k as (select e.*, target_speaker, exists (select 1 from e t where t.user_id = e.user_id and t.speaker = tg.target_speaker and (e.start + e."end") / 2 between t.start and t.turn_end) as hit from e join tg using (user_id)),
il as (select *, sum(case when hit then 0 else 1 end) over (partition by user_id order by pos) as island from k),
gr as (select user_id, target_speaker, island, arg_min(start, pos) as start, arg_max("end", pos) as "end", trim(string_agg(' ' || speaker, '' order by pos)) as text, count(*) as n_words from il where hit group by all)"""

DIARIZATION = f"""{ALIGNED},
du as (select user_id, max(greatest("end", turn_end)) as duration, count(*) as n_all from e group by 1),
nsp as (select user_id, count(*) as num_speakers from sp group by 1),
se as (select user_id, count(*) as num_segments, sum(greatest("end" - start, 0)) as seconds, string_agg(text, ' ' order by island) as text from gr group by 1),
sh as (select e.user_id, count(*) filter (where turn_end - start < 0.3)::double / count(*) as short_turn_ratio from e join tg on e.user_id = tg.user_id and e.speaker = tg.target_speaker group by 1),
b as (select user_id as video_id, cast(num_speakers as integer) as num_speakers, target_speaker, cast(turn_count as integer) as target_turn_count, duration, case when duration > 0 then total / duration else 0.0 end as share,
  cast(coalesce(num_segments, 0) as integer) as num_target_segments, coalesce(seconds / num_segments, 0.0) as avg_seconds, short_turn_ratio, {words("se.text")} as w, total, case when user_id % 2 = 0 then n_all end as full_words
  from tg join du using (user_id) join nsp using (user_id) join sh using (user_id) left join se using (user_id)),
c as (select *, cast(len(w) as integer) as target_word_count, case when total > 0 then len(w) / total else 0.0 end as wps, len(w)::double / nullif(full_words, 0) as retained, {repetition('w')} as rep from b)"""


DIARIZATION_FLAGS = """
df as (select *, list_filter([case when target_word_count = 0 then 'empty_target_text' end, case when num_speakers <= 1 then 'single_speaker_detected' end, case when num_speakers > 5 then 'many_speakers_detected' end,
  case when duration > 0 and share < 0.15 then 'low_target_speaker_share' end, case when short_turn_ratio > 0.3 then 'fragmented_turns' end, case when wps > 0 and wps < 1.0 then 'implausibly_slow' end,
  case when wps > 4.5 then 'implausibly_fast' end, case when retained < 0.05 then 'low_text_retention' end, case when rep > 0.3 then 'possible_repetition_artifact' end], lambda x: x is not null) as flags from c)"""

TRANSCRIPTS = f"""
v0 as (select user_id, event_id, event_type, value, row_number() over (partition by user_id order by ts, event_id) as pos, count(*) over (partition by user_id) as n from events),
v1 as (select *, n::double / (0.5::double + user_id % 6) as duration, case when user_id % 4 = 0 then 'w' || pos % 5 else event_type end || case when user_id % 2 = 1 then cast(pos as varchar) else '' end as word,
  case when user_id % 3 = 0 then 0.5::double + (value - floor(value)) / 2 else value - floor(value) end as p from v0),
v2 as (select user_id, any_value(duration) as duration, any_value(n) as n, case when user_id % 7 <> 0 then string_agg(word, ' ' order by pos) else '' end as text,
  case when user_id % 8 <> 0 then avg(p) end as conf, case when user_id % 8 <> 0 then count(*) filter (where p < 0.5)::double / count(*) end as low,
  least(sum(duration / n * case when user_id % 5 = 0 then 0.1::double else 0.9::double end) / any_value(duration), 1.0) as covered from v1 group by user_id),
v3 as (select *, {words('text')} as w from v2),
v4 as (select *, cast(len(w) as integer) as word_count, len(w) / duration as wps, {repetition('w')} as rep from v3),
tr as (select *, cast(user_id as varchar) as video_id, list_filter([case when conf < 0.7 then 'low_avg_confidence' end, case when low > 0.15 then 'many_low_confidence_words' end, case when wps > 0 and wps < 1.0 then 'implausibly_slow' end,
  case when wps > 4.5 then 'implausibly_fast' end, case when covered < 0.15 then 'low_speech_coverage' end, case when rep > 0.3 then 'possible_repetition_hallucination' end, case when word_count = 0 then 'empty_transcript' end], lambda x: x is not null) as flags from v4)"""

#: Word error rates by the rows of the cost table, all pairs a row at a time; insertions are a running minimum.
WORD_RATES = f"""with recursive p0 as (select conv_id * 1000 + turn as video_id, text as reference, lead(text) over (partition by conv_id order by turn) as hypothesis from conversations),
p as (select video_id, {words(normalised('reference'))} as r, {words(normalised('hypothesis'))} as h from p0 where hypothesis is not null),
g as (select video_id, unnest(h) as word, generate_subscripts(h, 1) as j from p),
c as (
  select video_id, 0 as i, unnest(range(0, cast(len(h) as bigint) + 1)) as j, unnest(range(0, cast(len(h) as bigint) + 1)) as cost from p
  union all
  select video_id, i + 1, j, j + min(t - j) over (partition by video_id order by j) from (
    select c.video_id, c.i, c.j, least(c.cost + 1, coalesce(lag(c.cost) over (partition by c.video_id order by c.j) + case when g.word = p.r[c.i + 1] then 0 else 1 end, c.cost + 1)) as t
    from c join p on p.video_id = c.video_id left join g on g.video_id = c.video_id and g.j = c.j where c.i < len(p.r)))
select p.video_id, round(case when len(r) > 0 then cost::double / len(r) else cost::double end, 6) as wer from c join p on p.video_id = c.video_id and c.i = len(p.r) and c.j = len(p.h)"""


def oracle_sql() -> dict[str, str]:
    label = "case when quality = 1 then 'success' else 'failed' end"
    # levenshtein() counts bytes: characters beyond ASCII are mapped to ASCII ones that normalised texts don't have
    free = " || ".join(["'ABCDEFGHIJKLMNOPQRSTUVWXYZ!#%&()*,-./:;?@[]_{}'", *[f"chr({i})" for i in (*range(1, 9), *range(14, 28), 127)]])
    cer = f"""p as (select conv_id * 1000 + turn as video_id, text as reference, lead(text) over (partition by conv_id order by turn) as hypothesis from conversations),
        n as (select video_id, {normalised('reference')} as r, {normalised('hypothesis')} as h from p where hypothesis is not null),
        o as (select distinct unnest(string_split(r || h, '')) as ch from n), m as (select coalesce(string_agg(ch, '' order by ch), '') as odd, left({free}, count(*)) as free from o where unicode(ch) > 127),
        c as (select video_id, levenshtein(translate(r, odd, free), translate(h, odd, free))::double as d, r from n, m), e as (select video_id, round(case when length(r) > 0 then d / length(r) else d end, 6) as cer from c)"""
    document_pairs = """b as (select row_number() over (order by item_id, text) - 1 as place, text as reference from benchmark),
        p as (select d.doc_id as video_id, b.reference, d.text as hypothesis from documents d left join b on b.place = coalesce(((d.doc_id % (select greatest(1, count(*)) from b)) + (select greatest(1, count(*)) from b)) % (select greatest(1, count(*)) from b), 0))"""
    caption_lines = f"list_transform(regexp_split_to_array(coalesce(html, ''), '{tx.LINE_END}'), lambda x: {strip('x')})"
    label_free = tx.SPEAKER_LABEL.replace("'", "''")
    spoken = f"list_filter({caption_lines}, lambda x: x <> '' and not regexp_matches(x, '{tx.CAPTION_HEADERS}') and not contains(x, '-->') and not regexp_matches(x, '{tx.DIGITS_ONLY}'))"
    plain = f"list_transform({spoken}, lambda x: regexp_replace(regexp_replace(x, '{tx.INLINE_TAG}', '', 'g'), '{label_free}', ''))"
    rule = "chr(10) || repeat('-', 80) || chr(10) || chr(10)"
    title = "case when toxic = 1 then null when quality = 1 then 'Title ' || doc_id else '' end"
    clean = strip("coalesce(d.text, '')")
    last = f"list_filter(list_transform(regexp_split_to_array(coalesce(text, ''), '{tx.LINE_END}'), lambda x: {strip('x')}), lambda x: x <> '')[-1]"
    return {
        "word_count": f"select doc_id, cast(len({words('text')}) as integer) as word_count from documents",
        "repetition_score": f"with w as (select doc_id, {words('text')} as w from documents) select doc_id, {repetition('w')} as repetition_score from w",
        "doc_quality_flags": f"with {DOC_QUALITY} select doc_id, round(duration, 6) as duration, word_count, round(words_per_second, 6) as words_per_second, repetition_score, array_to_string(flags, ',') as flags from q",
        "flagged_topn": f"with {DOC_QUALITY} select doc_id, cast(len(flags) as integer) as n_flags, array_to_string(flags, ',') as flags from q where len(flags) > 0 order by len(flags) desc, words_per_second, doc_id limit 20",
        "flag_counts": f"with {DOC_QUALITY} select flag, count(*) as n from (select unnest(flags) as flag from q) group by flag",
        "report_counts": f"with {DOC_QUALITY} select count(*) as num_files, count(*) filter (where len(flags) > 0) as num_flagged from q",
        "quality_report": f"with {DOC_QUALITY} select count(*) as num_files, count(*) filter (where len(flags) > 0) as num_flagged, cast(count(*) filter (where len(flags) > 0) as integer) as n_listed, md5(coalesce(string_agg(doc_id || ':' || array_to_string(flags, ','), ';' order by doc_id) filter (where len(flags) > 0), '')) as listed_md5 from q",
        "corpus_stats": f"with {DOC_QUALITY}, {STATS} select metric, round(mean, 6) as mean, round(median, 6) as median, round(min, 6) as min, round(max, 6) as max, round(p10, 6) as p10, round(p90, 6) as p90 from s",
        "stat_lines": f"with {DOC_QUALITY}, {STATS} select metric, printf('%-28s mean=%.3f median=%.3f p10=%.3f p90=%.3f min=%.3f max=%.3f', metric, mean, median, p10, p90, min, max) as line from s where metric in ('duration', 'word_count')",
        "speaker_stats": f"with {ROLES} select conv_id, speaker, total_seconds, turn_count from st",
        "speaker_maps": f"with {ROLES} select conv_id, cast(count(*) as integer) as num_speakers, string_agg(speaker, ',' order by speaker) as speakers from st group by conv_id",
        "target_speaker": f"with {ROLES} select conv_id, target_speaker from ch",
        "target_distribution": f"with {ROLES} select target_speaker, count(*) as n from ch group by 1",
        "target_segments": f'with {ROLE_SEGMENTS} select conv_id, id, start, "end", text from sg',
        "target_text": f"with {ROLE_SEGMENTS} select conv_id, string_agg(text, ' ' order by id) as text from sg group by conv_id",
        "aligned_segments": f'with {ALIGNED} select user_id, target_speaker, row_number() over (partition by user_id order by island) - 1 as id, round(start, 6) as start, round("end", 6) as "end", text from gr',
        "kept_words": f"with {EVENTS} select user_id, count(*) as n from e w where exists (select 1 from e t where t.user_id = w.user_id and t.speaker = 'purchase' and (w.start + w.\"end\") / 2 between t.start and t.turn_end) group by 1",
        "worst_diarized": f"""with {DIARIZATION}, {DIARIZATION_FLAGS} select cast(video_id as bigint) as video_id, printf('%s | speakers=%d share=%.2f retention=%s frag=%.2f rep=%.2f | %s', cast(video_id as varchar), num_speakers, share,
            case when retained is null then 'n/a' else printf('%.2f', retained) end, short_turn_ratio, rep, array_to_string(flags, ', ')) as line from df where len(flags) > 0 order by len(flags) desc, share, video_id limit 20""",
        "transcript_audit": f"with {TRANSCRIPTS} select video_id, word_count, round(duration, 6) as duration, round(conf, 6) as avg_word_confidence, round(low, 6) as low_confidence_word_ratio, round(wps, 6) as words_per_second, round(covered, 6) as speech_coverage_ratio, round(rep, 6) as repetition_score, array_to_string(flags, ',') as flags from tr",
        "transcript_flag_counts": f"with {TRANSCRIPTS} select flag, count(*) as n from (select unnest(flags) as flag from tr) group by flag",
        "worst_transcripts": f"""with {TRANSCRIPTS} select video_id, printf('%s | conf=%s wps=%.2f coverage=%.2f repetition=%.2f | %s', video_id, case when conf is null then 'n/a' else printf('%.2f', conf) end, wps, covered, rep, array_to_string(flags, ', ')) as line
            from tr where len(flags) > 0 order by len(flags) desc, coalesce(conf, 1.0), video_id limit 20""",
        "word_error_rates": WORD_RATES,
        # the reference's different words are characters, all other words one more; so are their distances
        "document_word_error_rates": f"""with {document_pairs}, w as (select video_id, {words(normalised('reference'))} as r, {words(normalised('hypothesis'))} as h from p), d as (select *, list_distinct(r) as d from w),
            s as (select video_id, len(r) as n, array_to_string(list_transform(r, lambda x: chr(cast(33 + list_position(d, x) as integer))), '') as a, array_to_string(list_transform(h, lambda x: chr(cast(33 + coalesce(list_position(d, x), 0) as integer))), '') as b from d)
            select video_id, round(case when n > 0 then levenshtein(a, b)::double / n else length(b)::double end, 6) as wer from s""",
        "diarization_quality": f"""with {DIARIZATION}, {DIARIZATION_FLAGS} select video_id, num_speakers, target_speaker, target_turn_count, num_target_segments, target_word_count, round(duration, 6) as duration, round(share, 6) as target_speaker_share,
            round(avg_seconds, 6) as avg_target_segment_seconds, round(short_turn_ratio, 6) as short_turn_ratio, round(wps, 6) as target_words_per_second, round(retained, 6) as target_text_retention_ratio, round(rep, 6) as repetition_score,
            array_to_string(flags, ',') as flags from df""",
        "confidence_stats": "with p as (select user_id, case when event_id % 11 <> 0 then value - floor(value) end as p from events) select user_id, round(avg(p), 9) as avg_word_confidence, case when count(p) > 0 then count(*) filter (where p < 0.5)::double / count(p) end as low_confidence_word_ratio from p group by 1",
        "speech_coverage": f'with {EVENTS}, c as (select user_id, max(turn_end) as duration, sum(greatest("end" - start, 0.0)) as spoken from e group by 1) select user_id, round(case when duration > 0 then least(spoken / duration, 1.0) else 0.0 end, 6) as speech_coverage_ratio from c',
        "pending_work": "select cast(doc_id as varchar) as video_id, source from documents where source <> 'src1' and doc_id not in (select doc_id from labels where quality = 1)",
        "run_summary": """with s as (select case when doc_id in (select doc_id from labels where quality = 1) then 'skipped' when lang <> 'en' then 'missing' else 'would_diarize' end as status from documents)
            select count(*) filter (where status = 'skipped') as skipped, count(*) filter (where status = 'missing') as missing, count(*) filter (where status = 'would_diarize') as would_diarize, count(*) as total from s""",
        "dedup_stem": "select 'f' || doc_id // 3 as stem, min('f' || doc_id // 3 || '.' || doc_id) as path from documents group by 1",
        "ledger_migration": f"select 'video' as mode, {label} as status, '' as title, '' as error, count(*) as n from labels group by all",
        "first_labelled": "select doc_id, lang from documents where doc_id in (select doc_id from labels) order by doc_id limit 1",
        "key_comparison": """with k as (select d.doc_id as a, l.doc_id as b from (select distinct doc_id from documents where source = 'src0') d full join (select distinct doc_id from labels) l on d.doc_id = l.doc_id)
            select count(a) as n_left, count(b) as n_right, count(*) filter (where a is not null and b is not null) as n_both, count(*) filter (where b is null) as only_left, count(*) filter (where a is null) as only_right from k""",
        "numbered_files": "select doc_id, row_number() over (partition by source order by doc_id) as i, count(*) over (partition by source) as n, '/data/' || source as folder, source || '/' || doc_id || '.json' as below from documents",
        "reference_coverage": """with b as (select case when l.doc_id % 2 <> 0 or d.doc_id is null then 'm' when l.toxic = 1 then 'e' else 's' end as b from labels l left join documents d on l.doc_id = d.doc_id)
            select count(*) filter (where b = 's') as num_scored, count(*) filter (where b = 'm') as missing_transcript, count(*) filter (where b = 'e') as empty_reference from b""",
        "caption_clean": f"select page_id, {strip(f'''regexp_replace(regexp_replace(array_to_string({plain}, ' '), '{tx.PARENTHESIS}', '', 'g'), '[{S}]+', ' ', 'g')''')} as text from pages",
        "topic_line": f"select doc_id, {topic('text')} as topic from documents",
        "export_blocks": f"""with r as (select d.doc_id, {clean} as text, {title} as title, l.doc_id is not null as known from documents d left join labels l on d.doc_id = l.doc_id),
            t as (select *, coalesce(nullif(title, ''), {topic('text')}) as topic from r)
            select doc_id, topic, case when coalesce(title, '') <> '' then 'title' when known then 'known_failure' else 'unknown' end as title_source, md5('Topic: ' || topic || chr(10) || 'Text: ' || text || chr(10)) as block_md5 from t""".replace("case when toxic = 1 then null when quality = 1 then 'Title ' || doc_id", "case when l.toxic = 1 then null when l.quality = 1 then 'Title ' || d.doc_id"),
        "combined_text": f"""with b as (select item_id, 'Topic: ' || {topic('text')} || chr(10) || 'Text: ' || {strip("coalesce(text, '')")} || chr(10) as block from benchmark), c as (select string_agg(block, {rule} order by item_id) as text from b)
            select md5(text) as text_md5, cast(length(text) as integer) as n_chars from c""",
        "normalise_text": f"select doc_id, md5({normalised('text')}) as normalised_md5 from documents",
        "text_scalars": f"""select doc_id, {last} as last_line, right({strip('text')}, 50) as tail, left(text, 30) as preview, source || '.v' || doc_id as stem, case when lang = 'es' then null else {strip('lang')} end as language, md5({sentence(strip('text'))}) as first_sentence_md5 from documents""",
        "word_counts_of_documents": f"with {document_pairs} select video_id, cast(len({words('reference')}) as integer) as reference_word_count, cast(len({words('hypothesis')}) as integer) as hypothesis_word_count from p",
        "cer_of_turns": f"with {cer} select video_id, cer from e",
        "worst_turns": f"with {cer} select video_id, cer from e order by cer desc, video_id limit 20",
        "metadata_project": f"""select cast(page_id as varchar) as id, regexp_extract(url, '^https?://([^/]+)', 1) as title, cast(length(html) as double) as duration, cast(null as boolean) as was_live, cast(null as bigint) as view_count,
            case when page_id % 2 = 0 and url <> '' then url else '{acquisition.URL_PREFIX}' || page_id end as url from pages""",
        "listing_entries": "select page_id as position, cast(page_id as varchar) as id from (select page_id from pages order by page_id limit 100) where page_id % 7 <> 0",
        "total_duration": "select round(sum(case when doc_id % 5 <> 0 then n_chars / 10.0::double else 0.0 end), 6) as total_duration, round(sum(case when doc_id % 5 <> 0 then n_chars / 10.0::double else 0.0 end) * 0.25, 6) as estimated_seconds from documents",
        "rate_parse": "select p_partkey, cast(floor((p_size + 0.5::double) * case p_partkey % 4 when 0 then 1024 when 1 then 1048576 when 2 then 1073741824 else 1 end) as bigint) as bytes_per_second from part",
        "backoff": "select n_nationkey, cast(greatest(n_nationkey % 5 - 1, 0) as integer) as n_waits, case when n_nationkey % 5 > 1 then 5.0::double * (power(2, n_nationkey % 5 - 1) - 1) else 0.0::double end as total_wait from nation",
        "download_plan": """with a as (select *, n_regionkey % 2 = 0 as audio, case when n_nationkey % 3 = 0 then 'lowest' else '720' end as v from nation)
            select n_nationkey, case when audio then 'audio' else 'video' end as mode, case when audio and v = 'lowest' then 'worstaudio/worst' when audio then 'bestaudio/best' else 'bestvideo[height<=' || v || ']+bestaudio/best[height<=' || v || ']' end as selector,
              case when n_nationkey % 4 = 0 then '/got/' || n_nationkey else '/out/' || n_nationkey || '.mp4' end as path, case when audio then 'pcm_s16le' else 'flac' end as codec from a""",
        "pair_generation": """with t as (select *, lead(role) over w as nr, lead(text) over w as nt from conversations window w as (partition by conv_id order by turn))
            select conv_id, turn, text as prompt, nt as response from t where role = 'user' and nr = 'assistant'""",
    }


