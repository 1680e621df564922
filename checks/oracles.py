"""SQL that gives the same rows as the registered queries, written from the rules."""

from __future__ import annotations

STOP = "('the','of','and','to','a','in','is','that','it','for','was','on','with','be','by','as','this','are','at','from','an','re','he')"
CENSOR = "('rewh','thatin','ononst','hehely')"
LANGS = "('ar','en','fr','in','pt','es','tr','ja')"
URL = r"(https?|ftp)://[^\t\r\n /$.?#][^\t\r\n ]*"
WORD = "[A-Za-z0-9''-]*[a-zA-Z][A-Za-z0-9''-]*"


def words_of(text: str) -> str:
    return f"regexp_extract_all(regexp_replace({text}, '{URL}', '', 'g'), '{WORD}')"


def masked(word: str) -> str:
    return f"(left({word}, 1) || repeat('*', length({word}) - 2) || right({word}, 1))"


def censored(text: str) -> str:
    segment = f"case when lower(s) in {CENSOR} then {masked('s')} else s end"
    segments = f"regexp_extract_all({text}, '[A-Za-z0-9]+|[^A-Za-z0-9]+')"
    return f"array_to_string(list_transform({segments}, lambda s: {segment}), '')"


def hits(text: str, phrase: str) -> str:
    """Occurrences of a phrase between blanks or text ends; the phrases hold no blank at
    their own ends, so occurrences that touch never count."""
    blank = "('', ' ', chr(9), chr(10), chr(11), chr(12), chr(13)"
    after = blank + ", chr(133), chr(8232), chr(8233))"
    parts = f"string_split({text}, {phrase})"
    left = f"{parts}[i]"
    right = f"{parts}[i + 1]"
    left_ok = f"case when {left} = '' then i = 1 else right({left}, 1) in {blank}) end"
    right_ok = f"case when {right} = '' then i = len({parts}) - 1 else left({right}, 1) in {after} end"
    return f"len(list_filter(range(1, len({parts})), lambda i: {left_ok} and {right_ok}))"


TIME_TEXT = "strftime({ts}, '%a %b %d %H:%M:%S +0000 %Y')"

# Documents as raw posts, copies of the low-quality ones included.
RAW_DOCUMENTS = f"""
raw as (
  select d.doc_id as post_id, d.text as doc_text, d.lang, d.source, d.n_chars, e.user_id as uid, e.value, e.event_type,
         cast(e.props->>'$.k' as bigint) as k, e.ts + to_days(cast(c.copy as integer)) as ts
  from documents d join events e on e.event_id = d.doc_id
  join (select doc_id, 0 as copy from documents
        union all select doc_id, 1 from labels where quality = 0) c on c.doc_id = d.doc_id),
flat as (
  select post_id, case when k >= 5 then uid end as user_id,
         case when value < 1 then '' when value < 2 then 'no time' else {TIME_TEXT.format(ts='ts')} end as created_at,
         case when k <> 99 then doc_text end as text, lang,
         case when value >= 3 then n_chars end as followers_count,
         case when event_type <> 'error' then k end as reshare_count,
         cast(floor(value) as bigint) as favorite_count, 'user_' || uid as screen_name, source as description, value, ts
  from raw),
valid as (
  select post_id, user_id, cast(floor(epoch(ts)) as bigint) as created_at, text, lang,
         coalesce(followers_count, 0) as followers_count, coalesce(reshare_count, 0) as reshare_count,
         coalesce(favorite_count, 0) as favorite_count
  from flat where user_id is not null and text <> '' and value >= 2),
deduped as (
  select post_id, user_id, created_at, text, followers_count, reshare_count, favorite_count from (
    select *, row_number() over (partition by post_id order by created_at, text) as rn
    from valid where lang = 'en') where rn = 1)
"""

# Events as contact posts.
CONTACTS = f"""
ev as (
  select e.event_id as post_id, e.user_id as user1_id, cast(e.props->>'$.k' as bigint) as k,
         cast(floor(e.value) as bigint) as other, e.event_type, e.value, cast(floor(epoch(e.ts)) as bigint) as created_at,
         d.text, d.lang
  from events e join documents d on d.doc_id = e.event_id % (select count(*) from documents)),
reply as (select *, k as user2_id, 'reply' as kind from ev where event_type in ('click', 'purchase')),
reshare as (select *, other as user2_id, 'reshare' as kind from ev where event_type = 'view'),
classified as (select * from reply union all select * from reshare),
contacts as (
  select * from classified
  where user1_id <> user2_id and value >= 2 and text <> '' and lang in {LANGS}),
weights as (
  select least(user1_id, user2_id) as user_lo, greatest(user1_id, user2_id) as user_hi,
         cast(sum(case kind when 'reply' then 2 else 1 end) as bigint) as weight
  from contacts group by 1, 2),
scored as (
  select c.user1_id, c.user2_id, c.text, max(c.created_at) as created_at, 1 + ln(1 + any_value(w.weight)) as intimacy_score
  from contacts c join weights w
    on w.user_lo = least(c.user1_id, c.user2_id) and w.user_hi = greatest(c.user1_id, c.user2_id)
  group by 1, 2, 3),
seen as (
  select user1_id as id, case when k < 90 then 'user_' || user1_id || '_' || k end as screen_name,
         case when k < 95 then lang end as description, created_at from contacts
  union all
  select other, 'user_' || other || '_' || event_type, null, created_at from contacts
  where event_type in ('view', 'purchase')),
profiles as (
  select id, screen_name, description from (
    select *, row_number() over (partition by id order by created_at desc, screen_name desc nulls last,
                                 description desc nulls last) as rn
    from seen where screen_name is not null or description is not null) where rn = 1),
both_ways as (
  select user1_id, user2_id, text, created_at, intimacy_score from scored
  union all select user2_id, user1_id, text, created_at, intimacy_score from scored),
facts as (
  select b.*, p.screen_name as user2_screen_name, p.description as user2_desc
  from both_ways b left join profiles p on p.id = b.user2_id)
"""

SHOWN_FACT = (
    "user1_id, user2_id, text, created_at, round(intimacy_score, 6) as intimacy_score, "
    "coalesce(user2_screen_name, '<null>') as user2_screen_name, coalesce(user2_desc, '<null>') as user2_desc"
)

# English documents as clean posts, their words and impact.
TOPICS = f"""
posts as (
  select d.doc_id as post_id, e.user_id, cast(floor(epoch(e.ts)) as bigint) as created_at, d.text,
         d.n_chars + cast(e.props->>'$.k' as bigint) + cast(floor(e.value) as bigint) as popularity
  from documents d join events e on e.event_id = d.doc_id where d.lang = 'en'),
occurrences as (select post_id, lower(unnest({words_of('text')})) as word from posts),
sizes as (
  select post_id, count(*) as num_words, count(*) filter (word not in {STOP}) as effective
  from occurrences group by post_id),
impacts as (
  select p.*, coalesce(s.num_words, 0) as num_words, coalesce(s.effective, 0) * p.popularity as impact
  from posts p left join sizes s using (post_id)),
word_rows as (
  select o.post_id, o.word, count(*) as cnt from occurrences o where word not in {STOP} group by 1, 2)
"""


def top_words(log: str, condition: str = "true") -> str:
    return f"""
usable as (select * from impacts where {condition}),
weights as (
  select w.word, count(*) as posts, sum(w.cnt * ln({log}) / u.num_words) as weight
  from word_rows w join usable u using (post_id) group by 1),
ranked as (
  select word, posts, round(ln((select count(*) from usable) / posts) * weight, 9) as score from weights),
top as (
  select row_number() over (order by score desc, word) as rank, word,
         case when word in {CENSOR} then {masked('word')} else word end as shown_word, posts, round(score, 6) as score
  from ranked qualify rank <= 20)
"""


# Topic queries for every supplier.
REQUESTS = f"""
requests as (
  select * from (
    select s_suppkey as request_id, s_suppkey as uid_lo,
           case when s_acctbal < 0 then s_suppkey - 1 else s_suppkey + s_nationkey end as uid_hi,
           1704067200 + s_nationkey * 3600 as t_lo,
           case when s_acctbal > 9000 then 4611686018427387904
                else 1704067200 + s_nationkey * 3600 + cast(floor(s_acctbal) as bigint) * 100 end as t_hi,
           5 + s_nationkey as n1, s_nationkey as n2
    from supplier) where n1 > 0 and n2 >= 0 and uid_lo <= uid_hi and t_lo <= t_hi),
matched as (
  select r.request_id, r.n1, r.n2, i.post_id, i.text, i.impact, i.num_words
  from requests r join impacts i on i.user_id between r.uid_lo and r.uid_hi and i.created_at between r.t_lo and r.t_hi),
totals as (select request_id, count(*) as n_posts from matched group by 1),
request_weights as (
  select m.request_id, any_value(m.n1) as n1, w.word, count(*) as posts,
         sum(w.cnt * ln(m.impact + 1) / m.num_words) as weight
  from matched m join word_rows w using (post_id) group by 1, 3),
request_scores as (
  select request_id, n1, word, posts, round(ln(n_posts / posts) * weight, 9) as score
  from request_weights join totals using (request_id)),
request_top as (
  select request_id, row_number() over (partition by request_id order by score desc, word) as rank, word,
         case when word in {CENSOR} then {masked('word')} else word end as shown_word, posts, round(score, 6) as score
  from request_scores qualify rank <= n1),
request_chosen as (
  select distinct m.request_id, m.n2, m.post_id, m.impact, m.text
  from matched m join word_rows w using (post_id) join request_top t on t.request_id = m.request_id and t.word = w.word),
request_posts as (
  select request_id, row_number() over (partition by request_id order by impact desc, post_id desc) as rank,
         post_id, impact, {censored('text')} as text
  from request_chosen qualify rank <= n2)
"""

# Wide topic queries for every nation: other requests, the same steps.
WIDE = REQUESTS[REQUESTS.index("matched as"):]
WIDE_REQUESTS = f"""
requests as (
  select n_nationkey as request_id, n_nationkey * 3 as uid_lo, 4611686018427387904 as uid_hi,
         1704067200 + n_nationkey * 7000 as t_lo, 1704067200 + (30 - n_nationkey) * 90001 as t_hi,
         3 + n_nationkey as n1, 4 as n2
  from nation),
{WIDE}"""

PER_CONTACT = """
select {by} f.user2_id, coalesce(max(f.user2_screen_name), '') as screen_name, coalesce(max(f.user2_desc), '') as description,
       arg_max(f.text, row(f.hits, f.created_at, f.text)) as text, cast(sum(f.hits) as bigint) as phrase_hits,
       max(f.intimacy_score) * (sum(f.hits) + 1) as raw_score
"""

PARITY = "bit_count(ascii(c)) % 2"
FRAME = f"""list_concat([length(c_name)], flatten(list_transform(string_split(c_name, ''), lambda c: [ascii(c), {PARITY}])))"""

# Damaged payloads: the position whose parity bit is wrong follows from how they were made.
AUDIT = """
payloads as (
  select c_custkey, c_mktsegment as source,
         case when c_acctbal < 0 then least(c_nationkey, 17) when c_acctbal > 9000 and length(c_name) > 10 then 10 end as first_bad
  from customer)
"""

# Fixed values below: the URL and word patterns restate the rules of the texts.
ORACLES: dict[str, str] = {
    "post_flatten": f"""with {RAW_DOCUMENTS}
        select post_id, coalesce(user_id, -1) as user_id, created_at, coalesce(text, '<null>') as text, lang,
               coalesce(followers_count, -1) as followers_count, coalesce(reshare_count, -1) as reshare_count,
               favorite_count, screen_name, description, true as has_hashtag from flat""",
    "post_clean": f"with {RAW_DOCUMENTS} select * from valid",
    "post_time_parse": f"""with {RAW_DOCUMENTS}
        select post_id, created_at as time_text,
               coalesce(cast(epoch(try_strptime(created_at, '%a %b %d %H:%M:%S +0000 %Y')) as bigint), -1) as created_at
        from flat""",
    "post_lang_filter": f"with {RAW_DOCUMENTS} select post_id, lang, created_at from flat where lang in {LANGS}",
    "post_dedupe": f"with {RAW_DOCUMENTS} select * from deduped",
    "contact_classify": f"with {CONTACTS} select post_id, user1_id, user2_id, kind from classified",
    "contact_no_self": f"""with {CONTACTS}
        select post_id, user1_id, user2_id, kind from classified where user1_id <> user2_id""",
    "contact_union": f"with {CONTACTS} select post_id, user1_id, user2_id, kind, created_at from contacts",
    "contact_mirror": f"""with {CONTACTS}
        select post_id, user1_id, user2_id, kind, created_at from contacts
        union all select post_id, user2_id, user1_id, kind, created_at from contacts""",
    "pair_weight": f"with {CONTACTS} select * from weights",
    "pair_scores": f"""with {CONTACTS}
        select user_lo as user1_id, user_hi as user2_id, round(1 + ln(1 + weight), 6) as intimacy_score from weights
        union all select user_hi, user_lo, round(1 + ln(1 + weight), 6) from weights""",
    "contact_scored": f"""with {CONTACTS}
        select user1_id, user2_id, text, created_at, round(intimacy_score, 6) as intimacy_score from scored""",
    "latest_profile": f"""with {CONTACTS}
        select id, coalesce(screen_name, '<null>') as screen_name, coalesce(description, '<null>') as description
        from profiles""",
    "contact_serving": f"""with {CONTACTS}
        select {SHOWN_FACT} from facts""",
    "contact_lookup": f"""with {CONTACTS}
        select {SHOWN_FACT} from facts where user1_id = 8""",
    "phrase_count": f"select doc_id, {hits('text', chr(39) + 'the' + chr(39))} as hits from documents",
    "contact_rank": f"""with {CONTACTS},
        counted as (select *, {hits('text', chr(39) + 'the' + chr(39))} as hits from facts where user1_id = 8),
        per_contact as ({PER_CONTACT.format(by='')} from counted f group by f.user2_id)
        select row_number() over (order by raw_score desc, user2_id) as rank, * exclude (raw_score),
               round(raw_score, 6) as score
        from per_contact qualify rank <= 10""",
    "contact_requests": f"""with {CONTACTS},
        requests as (
          select c_custkey as request_id, c_custkey as user_id, cast(floor(c_acctbal / 1000) as integer) as n,
                 case c_mktsegment when 'AUTOMOBILE' then 'of the' when 'BUILDING' then 'en' else 'the' end as phrase
          from customer where c_nationkey <> 24 and c_mktsegment <> 'MACHINERY' and floor(c_acctbal / 1000) > 0),
        joined as (select r.request_id, r.n, r.phrase, f.* from requests r join facts f on f.user1_id = r.user_id),
        counted as (select *, {hits('text', 'phrase')} as hits from joined),
        per_contact as ({PER_CONTACT.format(by='f.request_id, f.n,')} from counted f group by f.request_id, f.n, f.user2_id)
        select request_id, row_number() over (partition by request_id order by raw_score desc, user2_id) as rank,
               user2_id, screen_name, description, text, phrase_hits, round(raw_score, 6) as score
        from per_contact qualify rank <= n""",
    "contact_nested": f"""with {CONTACTS}
        select user1_id, count(distinct user2_id) as n_contacts, count(*) as n_texts, max(created_at) as latest
        from facts group by 1""",
    "contact_list": f"""with {CONTACTS},
        per_contact as (
          select user1_id, user2_id, coalesce(max(user2_screen_name), '<null>') as screen_name, count(*) as n_texts,
                 min(created_at) as first_time, max(created_at) as last_time, arg_max(text, row(created_at, text)) as last_text
          from facts where user1_id = 8 group by 1, 2)
        select *, row_number() over (order by user2_id) as place from per_contact""",
    "contact_json_roundtrip": f"""with {CONTACTS}
        select user1_id, user2_id, count(*) as n_texts, cast(sum(length(text)) as bigint) as n_chars,
               cast(sum(created_at) as bigint) as sum_times, coalesce(max(user2_screen_name), '') as screen_name,
               round(max(intimacy_score), 6) as intimacy_score
        from facts group by 1, 2""",
    "post_range_scan": """select d.doc_id as post_id, e.user_id, cast(floor(epoch(e.ts)) as bigint) as created_at
        from documents d join events e on e.event_id = d.doc_id
        where e.user_id between 10 and 60 and cast(floor(epoch(e.ts)) as bigint) between 1704067200 and 1705000000""",
    "strip_urls": f"""select page_id, regexp_replace('at ' || url || ' ' || html, '{URL}', '', 'g') as text from pages""",
    "extract_words": f"""select doc_id, array_to_string({words_of('text')}, ' ') as words, len({words_of('text')}) as n_words
        from documents""",
    "word_explode": f"""select word, count(*) as n from (select lower(unnest({words_of('text')})) as word from documents) group by 1""",
    "stopword_antijoin": f"""select word, count(*) as n from (select lower(unnest({words_of('text')})) as word from documents)
        where word not in {STOP} group by 1""",
    "impact_score": f"with {TOPICS} select post_id, num_words as n_words, impact from impacts",
    "censor_text": f"select doc_id, {censored('text')} as censored_text from documents",
    "scored_posts": f"""with {RAW_DOCUMENTS},
        words as (select post_id, lower(unnest({words_of('text')})) as word from deduped),
        effective as (select post_id, count(*) as n from words where word not in {STOP} group by 1)
        select d.post_id, d.user_id, d.created_at, d.text, {censored('d.text')} as censored_text,
               coalesce(f.n, 0) * (d.followers_count + d.reshare_count + d.favorite_count) as impact
        from deduped d left join effective f using (post_id)""",
    "word_weight": f"""with {TOPICS}
        select w.word, count(*) as posts, round(sum(w.cnt * ln(i.impact + 1) / i.num_words), 6) as weight
        from word_rows w join impacts i using (post_id) group by 1""",
    "topic_words": f"with {TOPICS}, {top_words('u.impact + 1')} select * from top",
    "word_ranking": f"""with {TOPICS}, {top_words('u.impact + 1')}
        select row_number() over (order by score desc, word) as rank, word, posts, round(score, 6) as score from ranked""",
    "topic_words_ln": f"with {TOPICS}, {top_words('u.impact', 'impact > 0')} select * from top",
    "topic_posts": f"""with {TOPICS}, {top_words('u.impact + 1')},
        chosen as (select distinct post_id from word_rows where word in (select word from top))
        select row_number() over (order by impact desc, post_id desc) as rank, post_id, impact, {censored('text')} as text
        from impacts where post_id in (select post_id from chosen) qualify rank <= 10""",
    "topic_requests": f"with {TOPICS}, {REQUESTS} select * from request_top",
    "topic_requests_posts": f"with {TOPICS}, {REQUESTS} select * from request_posts",
    "topic_requests_wide": f"with {TOPICS}, {WIDE_REQUESTS} select * from request_top",
    "rot13_decode": """select doc_id, translate(text, 'abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'nopqrstuvwxyzabcdefghijklmNOPQRSTUVWXYZABCDEFGHIJKLM') as decoded from documents""",
    "post_json_lines": f"""with {RAW_DOCUMENTS}
        select post_id, coalesce(text, '<null>') as text, coalesce(reshare_count, -1) as retweet_count
        from flat where coalesce(reshare_count, 0) not in (7, 8, 9, 10)""",
    "rejected_lines": f"""with {RAW_DOCUMENTS}
        select case coalesce(reshare_count, 0) when 7 then 'no json' when 8 then 'field favorite_count' when 9 then 'blank'
               when 10 then 'no object' else 'good' end as reason, count(*) as n from flat group by 1""",
    "word_lines": """select lower(translate(c_name, 'abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'nopqrstuvwxyzabcdefghijklmNOPQRSTUVWXYZABCDEFGHIJKLM')) as word from customer where c_nationkey > 0""",
    "censor_lines": "select lower(c_name) as word, lower(c_mktsegment) as mask from customer where c_nationkey > 0",
    "post_words": f"""with {TOPICS}
        select w.post_id, w.word, w.cnt, s.num_words from word_rows w join sizes s using (post_id)""",
    "frame_payload": f"select c_custkey, array_to_string({FRAME}, ',') as payload from customer",
    "audit_payloads": f"""with {AUDIT}
        select source, count(*) filter (first_bad is null) as good, count(*) filter (first_bad is not null) as bad
        from payloads group by 1""",
    "quarantine_payloads": f"with {AUDIT} select c_custkey, source, cast(first_bad as bigint) as first_bad from payloads where first_bad is not null",
}

# The same rows by other routes: dictionaries as tables, words as a stored table.
for _route, _key in (
    ("censor_text_by_table", "censor_text"),
    ("scored_posts_by_tables", "scored_posts"),
    ("word_weight_by_table", "word_weight"),
    ("topic_words_stored", "topic_words"),
    ("post_range_scan_stored", "post_range_scan"),
    ("topic_requests_by_cells", "topic_requests"),
    ("topic_requests_posts_by_cells", "topic_requests_posts"),
    ("topic_posts_stored", "topic_posts"),
    ("topic_posts_by_postings", "topic_posts"),
    ("contact_scored_merged", "contact_scored"),
    ("contact_serving_bucketed", "contact_serving"),
):
    ORACLES[_route] = ORACLES[_key]

ORACLES["topic_serving"] = f"select * exclude (censored_text) from ({ORACLES['scored_posts']})"
ORACLES["contact_report"] = f"""
    select string_agg(screen_name || chr(9) || description || chr(9) || text, chr(10) order by rank) as report
    from ({ORACLES['contact_rank']})"""
ORACLES["topic_report"] = f"""
    select (select string_agg(shown_word || ':' || cast(cast(round(cast(score as decimal(38,6)), 2) as decimal(38,2)) as varchar),
                              chr(9) order by rank) from ({ORACLES['topic_words']}))
           || chr(10)
           || (select string_agg(least(impact, 2147483647) || chr(9) || post_id || chr(9) || text, chr(10) order by rank)
               from ({ORACLES['topic_posts']})) as report"""
