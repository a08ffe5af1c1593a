"""SQL oracles: what each registered query must return, written for DuckDB over the same tables."""

from __future__ import annotations

from townsquare.functions.lemmas import NOUN_EXCEPTIONS
from townsquare.functions.sentiment import BOOSTERS, LEXICON, NEGATORS
from townsquare.functions.text import FUSED_WORDS, STOP_WORDS

SPACE = r"\s\x0b\x1c-\x1f\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
KEPT = "a-zA-Z0-9áéíóúñü¿?¡!.,;:"
DOMAINS = ("Data", "License", "Worthless", "Threat", "Best")
RULE_LEXICON = {"with": 1.5, "there": -2.0, "this": 0.8, "license": 2.5, "worthless": -1.9, "les": 0.5, "und": -0.7}
RULE_BOOSTERS = {"the": 0.293, "of": -0.293, "der": 0.293}
RULE_NEGATORS = ("and", "not", "que")
TYPES = "('click', 'error', 'purchase', 'signup', 'view')"

# --- shared views -------------------------------------------------------------------------------

POSTS = """
posts as (
  select e.event_id, cast(e.event_id as varchar) as id, e.ts as created_at, cast(e.ts as date) as day,
         case when e.event_id % 2 = 0 then 'twitter' else 'reddit_kaggle' end as data_source,
         cast(e.user_id as varchar) as user_id,
         case when e.event_id % 2 = 1 then cast(e.user_id as varchar) end as author,
         e.event_type as subreddit,
         case when e.event_id % 2 = 0 then e.value end as user_followers_count,
         case when e.event_id % 2 = 0 then floor(e.value * 0.3) end as retweet_count,
         case when e.event_id % 2 = 0 then floor(e.value * 0.7) end as favorite_count,
         case when e.event_id % 2 = 1 then floor(e.value) end as score,
         case when e.event_id % 2 = 1
              then cast(regexp_extract(e.props, '([0-9]+)', 1) as double) end as comments,
         case when e.event_id % 2 = 0 then abs(floor(e.value * 0.3)) + abs(floor(e.value * 0.7)) else 0 end
           as twitter_engagement,
         case when e.event_id % 2 = 1
              then abs(floor(e.value)) + 2 * cast(regexp_extract(e.props, '([0-9]+)', 1) as double)
              else 0 end as reddit_engagement,
         d.text, cast(p.user_id as varchar) as in_reply_to_user_id
  from events e
  left join documents d on d.doc_id = e.event_id
  left join events p on p.event_id = e.event_id - 1
), engaged as (
  select *, twitter_engagement + reddit_engagement as total_engagement from posts
)"""


def on_posts(body: str, more: str = "") -> str:
    return f"with {POSTS}{', ' + more if more else ''} {body}"


def clean(expression: str) -> str:
    t = f"lower(coalesce({expression}, ''))"
    t = f"regexp_replace({t}, 'http[^{SPACE}]+|www[^{SPACE}]+', '', 'g')"
    t = f"regexp_replace({t}, '<[^\\n]*?>', '', 'g')"
    t = f"regexp_replace({t}, '[^{KEPT}{SPACE}]', '', 'g')"
    return f"trim(regexp_replace({t}, '[{SPACE}]+', ' ', 'g'))"


def words_in(cleaned: str) -> str:
    return f"len(list_filter(string_split({cleaned}, ' '), lambda w: w <> ''))"


def token_list(expression: str) -> str:
    t = f"lower(coalesce({expression}, ''))"
    t = f"regexp_replace({t}, 'http[^{SPACE}]+|www[^{SPACE}]+', '', 'g')"
    t = f"regexp_replace({t}, '[^{SPACE}]*\\.com[^{SPACE}]*|[^{SPACE}]*\\.org[^{SPACE}]*', '', 'g')"
    t = f"regexp_replace({t}, '[^a-zA-Z{SPACE}]', '', 'g')"
    for first, second in FUSED_WORDS:
        t = f"regexp_replace({t}, '\\b{first}{second}\\b', '{first} {second}', 'g')"
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    return f"list_filter(regexp_split_to_array({t}, '[{SPACE}]+'), lambda w: len(w) > 2 and w not in ({stop}))"


def values(pairs: dict[str, float]) -> str:
    return ", ".join(f"('{word}', {score}::double)" for word, score in pairs.items())


def scored(lexicon, boosters, negators, source: str) -> str:
    """CTEs ending in ``scores(id, compound)`` for ``source`` rows (id, cleaned)."""
    negations = ", ".join(f"('{word}')" for word in negators)
    return f"""
src as ({source}),
lexicon(word, value) as (values {values(lexicon)}),
booster(word, value) as (values {values(boosters)}),
negator(word) as (values {negations}),
listed as (select id, cleaned, list_filter(regexp_split_to_array(cleaned, '[^a-z0-9áéíóúñü]+'), lambda w: w <> '') as ws from src),
words as (select id, unnest(ws) as word, generate_subscripts(ws, 1) as place from listed where len(ws) > 0),
buts as (select id, min(place) as but from words where word = 'but' group by id),
hits as (select w.id, w.place, l.value from words w join lexicon l using (word)),
around as (
  select h.id, h.place,
         sum(case when l.word is null then b.value * case h.place - w.place when 1 then 1.0 when 2 then 0.95 else 0.9 end end) as shift,
         count(n.word) as flips
  from hits h join words w on w.id = h.id and w.place between h.place - 3 and h.place - 1
  left join lexicon l on l.word = w.word
  left join booster b on b.word = w.word
  left join negator n on n.word = w.word
  group by h.id, h.place
),
raw as (
  select h.id, sum((h.value + sign(h.value) * coalesce(a.shift, 0)) * pow(-0.74::double, coalesce(a.flips, 0))
           * case when b.but is null or h.place = b.but then 1.0 when h.place < b.but then 0.5 else 1.5 end) as s
  from hits h left join around a using (id, place) left join buts b using (id) group by h.id
),
marks as (
  select id, least(4, len(cleaned) - len(replace(cleaned, '!', ''))) * 0.292::double
    + case when len(cleaned) - len(replace(cleaned, '?', '')) > 3 then 0.96::double
           when len(cleaned) - len(replace(cleaned, '?', '')) > 1
           then 0.18::double * (len(cleaned) - len(replace(cleaned, '?', ''))) else 0 end as emphasis
  from src
),
moved as (select m.id, coalesce(r.s, 0) + sign(coalesce(r.s, 0)) * m.emphasis as s from marks m left join raw r using (id)),
scores as (select id, round(greatest(-1, least(1, s / sqrt(s * s + 15))), 4) + 0.0 as compound from moved)"""


DOCUMENT_SOURCE = f"select doc_id as id, {clean('text')} as cleaned from documents"
POST_SOURCE = f"select id, {clean('text')} as cleaned from posts"
LABEL = "case when {0} >= 0.05 then 'positive' when {0} <= -0.05 then 'negative' else 'neutral' end"

POST_TEXTS = scored(LEXICON, BOOSTERS, NEGATORS, POST_SOURCE) + f""",
texts as (
  select e.*, src.cleaned as text_cleaned, {words_in('src.cleaned')} as word_count, compound,
         {LABEL.format('compound')} as sentiment_label
  from engaged e join src using (id) join scores using (id)
), polar as (select *, compound as polarity from texts)"""

TAGS = "array_to_string(list_filter([{}], lambda w: w is not null), '|')".format(
    ", ".join("case when contains({0}, '" + d.lower() + "') then '" + d + "' end" for d in DOMAINS)
)


def calendar(daily: str) -> str:
    """CTEs ``daily(day, …)`` and ``days(day)``, the calendar between its first and last day."""
    return f"""daily as ({daily}),
days as (select cast(unnest(generate_series((select min(day) from daily)::timestamp, (select max(day) from daily)::timestamp,
         interval 1 day)) as date) as day)"""


DAILY_METRICS = POST_TEXTS + ", " + calendar(
    "select day, avg(polarity) as sentiment_polarity, sum(total_engagement) as total_engagement, "
    "sum(reddit_engagement) as reddit_engagement, cast(sum(word_count) as bigint) as word_count from polar group by day"
) + """,
metrics as (
  select days.day, sentiment_polarity, coalesce(total_engagement, 0) as total_engagement,
         coalesce(reddit_engagement, 0) as reddit_engagement, coalesce(word_count, 0) as word_count
  from days left join daily using (day) where sentiment_polarity is not null
)"""


def average_ranks(source: str, column: str) -> str:
    return (
        f"select *, rank() over (order by {column}) + (count(*) over (partition by {column}) - 1) / 2.0 as rk "
        f"from {source}"
    )


def correlation_p(r: str, n: str) -> str:
    """Two-sided p of a correlation: Student's t with n - 2 degrees of freedom as a finite sum, for even and odd ones."""
    x = f"greatest(1 - {r} * {r}, 1e-300)"
    even = f"list_sum(list_transform(range(0, ({n} - 2) // 2), lambda j: exp(lgamma(j + 0.5) - lgamma(j + 1) - 0.5 * ln(pi()) + j * ln({x}))))"
    odd = (
        f"coalesce(list_sum(list_transform(range(1, ({n} - 3) // 2 + 1), lambda j: exp(0.5 * ln(pi()) - ln(2) + lgamma(j) - lgamma(j + 0.5) "
        f"+ (j - 0.5) * ln({x})))), 0)"
    )
    return f"1 - case when {n} % 2 = 0 then abs({r}) * {even} else 2 / pi() * (asin(abs({r})) + abs({r}) * {odd}) end"


def normal_p(z: str) -> str:
    """Two-sided p of a standard normal value, by its power series; beyond 6 it is 0 in the digits compared."""
    terms = (
        f"list_sum(list_transform(range(0, 120), lambda k: exp((2 * k + 1) * ln(greatest({z}, 1e-300)) - {z} * {z} / 2 "
        f"- ((k + 1) * ln(2) + lgamma(k + 1.5) - 0.5 * ln(pi())))))"
    )
    return f"case when {z} <= 0 then 1.0 when {z} > 6 then 0.0 else 1 - sqrt(2 / pi()) * {terms} end"


def reported(body: str) -> str:
    """Report rows of ``body`` rows (name, n, correlation, method_used): rounded, with p and significance."""
    return (
        "select name, n, round(correlation, 6) + 0.0 as correlation, round(p, 6) + 0.0 as p_value, method_used, p < 0.05 as significant "
        f"from (select *, {correlation_p('correlation', 'n')} as p from ({body}))"
    )


def spearman(name: str, x: str, y: str, table: str, where: str = "true") -> str:
    return f"""
select '{name}' as name, count(*) as n, corr(rx, ry) as correlation, 'spearman' as method_used from (
  select rank() over (order by x) + (count(*) over (partition by x) - 1) / 2.0 as rx,
         rank() over (order by y) + (count(*) over (partition by y) - 1) / 2.0 as ry
  from (select {x} as x, {y} as y from {table} where {where} and {x} is not null and {y} is not null))"""


def f_ratio(source: str, tag: str = "") -> str:
    """F of ``source`` rows (g, v), in a CTE named f with the tag."""
    return f"""
grouped{tag} as (select g, count(*) as n, avg(v) as m, var_pop(v) as s from ({source}) group by g),
total{tag} as (select avg(v) as m from ({source})),
f{tag} as (select count(*) as k, cast(sum(n) as bigint) as n,
       sum(n * (g.m - t.m) ** 2) / (count(*) - 1) / (sum(n * s) / (sum(n) - count(*))) as statistic
      from grouped{tag} g, total{tag} t)"""


def kruskal(source: str) -> str:
    """H of ``source`` rows (g, v)."""
    return f"""
ranked as (select g, v, rank() over (order by v) + (count(*) over (partition by v) - 1) / 2.0 as rk from ({source})),
sums as (select g, count(*) as n, sum(rk) as r from ranked group by g),
ties as (select sum(pow(t, 3) - t) as t from (select count(*)::double as t from ranked group by v)),
h as (select count(*) as k, cast(sum(n) as bigint) as n,
        (12 / (sum(n) * (sum(n) + 1)) * sum(r * r / n) - 3 * (sum(n) + 1))
          / (1 - max(ties.t) / (pow(sum(n), 3) - sum(n))) as statistic from sums, ties)"""


def mann_whitney(source: str) -> str:
    return f"""
ranked as (select g, v, rank() over (order by v) + (count(*) over (partition by v) - 1) / 2.0 as rk from ({source})),
u as (select count(*) filter (g = 'twitter') as n1, count(*) filter (g <> 'twitter') as n2,
        sum(rk) filter (g = 'twitter') - count(*) filter (g = 'twitter') * (count(*) filter (g = 'twitter') + 1) / 2.0
          as statistic from ranked),
ties as (select sum(pow(t, 3) - t) as t from (select count(*)::double as t from ranked group by v))"""


def seasonal(multiplicative: bool) -> str:
    out = "observed / trend" if multiplicative else "observed - trend"
    centre = "m / avg(m) over ()" if multiplicative else "m - avg(m) over ()"
    rest = "observed / seasonal / trend" if multiplicative else "observed - trend - seasonal"
    digits = 6 if multiplicative else 4
    return f"""{DAILY_METRICS},
trended as (
  select day, total_engagement as observed, (row_number() over (order by day) - 1) % 7 as phase,
         case when count(*) over w = 7 then avg(total_engagement) over w end as trend
  from metrics window w as (order by day rows between 3 preceding and 3 following)
),
phases as (select phase, {centre} as seasonal from (select phase, avg({out}) as m from trended group by phase))
select day, observed, round(trend, {digits}) + 0.0 as trend, round(seasonal, {digits}) + 0.0 as seasonal,
       round({rest}, {digits}) + 0.0 as resid
from trended join phases using (phase)"""


COMMUNITY = """
rd as (select author, subreddit, score, row_number() over (partition by author, subreddit order by created_at desc, id desc) as k
       from posts where data_source like '%reddit%'),
edges as (select least(author, subreddit) as src, greatest(author, subreddit) as dst, coalesce(score, 1) as weight
          from rd where k = 1),
written as (
  select author as id, 'user' as type, 'reddit' as source, null as followers, 0 as phase, created_at, id as post
    from posts where author is not null
  union all select subreddit, 'community', 'reddit', null, 0, created_at, id from posts where author is not null
  union all select user_id, 'user', 'twitter', user_followers_count, 1, created_at, id from posts where data_source = 'twitter'
),
placed as (select *, row_number() over (partition by id order by phase desc, created_at desc, post desc) as k from written),
nodes as (select id, type, source, followers from placed where k = 1)"""

REPLIES = """
redges as (select distinct least(user_id, in_reply_to_user_id) as src, greatest(user_id, in_reply_to_user_id) as dst
           from posts where in_reply_to_user_id is not null),
rnodes as (select user_id as id from posts union select in_reply_to_user_id from posts where in_reply_to_user_id is not null),
ends as (select src as id from redges union all select dst from redges),
degrees as (select rnodes.id, count(ends.id) as degree from rnodes left join ends using (id) group by rnodes.id),
central as (select id, degree, round(degree / ((select count(*) from rnodes) - 1)::double, 6) + 0.0 as centrality from degrees)"""


def pagerank(rounds: int, body: str = "select id, round(rank, 8) + 0.0 as rank from {last}") -> str:
    steps = [
        f"""{COMMUNITY},
arcs as (select src, dst, weight from edges where weight > 0
         union all select dst, src, weight from edges where weight > 0 and src <> dst),
outs as (select src, sum(weight) as w from arcs group by src),
p0 as (select id, 1.0::double / (select count(*) from nodes) as rank from nodes)"""
    ]
    for i in range(rounds):
        steps.append(
            f"""p{i + 1} as (
  select nodes.id, 0.85 * coalesce(f.flow, 0)
     + (0.85 * coalesce((select sum(rank) from p{i} where id not in (select src from outs)), 0) + 0.15)
       / (select count(*) from nodes) as rank
  from nodes left join (select dst as id, sum(rank * weight / w) as flow
                        from arcs join outs using (src) join p{i} on p{i}.id = arcs.src group by dst) f using (id))"""
        )
    return on_posts(body.replace("{last}", f"p{rounds}"), ", ".join(steps))


def topic_model(k: int, rounds: int, fold_in: int, seed: int = 42) -> str:
    """CTEs of the topic model over the documents: weights w<rounds>, sizes, totals and, for each text, f<fold_in>."""
    topics, prior = range(k), f"{1 / k!r}::double"

    def shared(source: str, totals: str, known: bool) -> str:
        parts = [f"(w{i} + {prior}) / (s{i} + {prior} * size)" + (f" * (t{i} + {prior})" if known else "") for i in topics]
        whole = " + ".join(f"p{i}" for i in topics)
        return (
            "select text, term, " + ", ".join(f"n * p{i} / ({whole}) as g{i}" for i in topics)
            + " from (select text, term, n, " + ", ".join(f"{p} as p{i}" for i, p in enumerate(parts)) + f" from {source}, {totals}, sizes)"
        )

    def sums(source: str, key: str, name: str) -> str:
        return f"select {key}, " + ", ".join(f"sum(g{i}) as {name}{i}" for i in topics) + f" from {source} group by {key}"

    steps = [
        f"toks as (select doc_id as text, {token_list('text')} as ws from documents)",
        "long_texts as (select text, ws from toks where len(array_to_string(ws, ' ')) > 10)",
        "spread as (select text, unnest(ws) as term from long_texts)",
        "found as (select term from (select distinct text, term from spread) group by term having count(*) >= 2 "
        "and count(*) <= 0.95 * (select count(*) from long_texts))",
        "sizes as materialized (select count(*) as size from found)",
        "counts as materialized (select text, term, count(*) as n from spread join found using (term) group by all)",
        "w0 as materialized (select term, "
        + ", ".join(f"('0x' || substr(md5('{seed}|{i}|' || term), 1, 8))::bigint / 4294967296.0::double as w{i}" for i in topics)
        + " from found)",
    ]
    total = ", ".join(f"sum(w{i}) as s{i}" for i in topics)
    for number in range(rounds):
        steps.append(f"s{number} as materialized (select {total} from w{number})")
        source = f"counts join w{number} using (term)" + (f" join t{number} using (text)" if number else "")
        steps.append(f"g{number} as materialized ({shared(source, f's{number}', bool(number))})")
        steps.append(f"w{number + 1} as materialized ({sums(f'g{number}', 'term', 'w')})")
        steps.append(f"t{number + 1} as materialized ({sums(f'g{number}', 'text', 't')})")
    steps.append(f"totals as materialized (select {total} from w{rounds})")
    for number in range(fold_in):
        source = f"counts join w{rounds} using (term)" + (f" join f{number} using (text)" if number else "")
        steps.append(f"f{number + 1} as materialized ({sums('(' + shared(source, 'totals', bool(number)) + ')', 'text', 't')})")
    return "with " + ", ".join(steps)


#: Days the daily stream has closed when all events are read.
CLOSED = "cast(created_at as date) + interval 1 day <= (select max(ts) from events) - interval 2 day"


def watched(through: str) -> str:
    """CTEs ending in ``w``: each source's days up to ``through`` with running figures."""
    return f"""
by_day as (select data_source, day, count(*) as count, avg(polarity) as m from polar where day <= {through} group by all),
spans as (select data_source, cast(unnest(generate_series(min(day)::timestamp, {through}::timestamp, interval 1 day)) as date) as day
          from by_day group by data_source),
w as (select data_source, day, coalesce(count, 0) as count, m, avg(m) over (u rows between 2 preceding and current row) as recent,
             row_number() over u as days,
             avg(coalesce(count, 0)) over (u rows unbounded preceding) + stddev_samp(coalesce(count, 0)) over (u rows unbounded preceding) as lim
      from spans left join by_day using (data_source, day) window u as (partition by data_source order by day))"""


WATCHED = (
    "select data_source, day, count, round(m, 6) + 0.0 as mean_sentiment, round(recent, 6) + 0.0 as recent_sentiment, "
    "round(lim, 6) + 0.0 as \"limit\", coalesce(days > 5 and count > lim, false) as volume_alert, coalesce(m < 0.01, false) as sentiment_alert from w"
)


# Each token replaced by its lemma, the list joined again.
PLACED = """
placed as (select doc_id, unnest(ws) as token, generate_subscripts(ws, 1) as place from toks where len(ws) > 0),
joined as (select doc_id, string_agg(coalesce(lemma, token), ' ' order by place) as t
           from placed left join lemmas using (token) group by doc_id)
select doc_id, coalesce(t, '') as text_tokens_clean from documents left join joined using (doc_id)"""

PLURALS = f"""
toks as (select doc_id, {token_list('text')} as ws from documents),
vocabulary as (select distinct unnest(ws) as token from toks),
lemmas as (select a.token, b.token as lemma from vocabulary a join vocabulary b on a.token = b.token || 's'),
{PLACED}"""

NOUNS = f"""
toks as (select doc_id, {token_list('text')} as ws from documents),
vocabulary as (select token, count(*) as n from (select unnest(ws) as token from toks) group by token),
rules(suffix, ending) as (values ('s', ''), ('ses', 's'), ('ves', 'f'), ('xes', 'x'), ('zes', 'z'),
                                 ('ches', 'ch'), ('shes', 'sh'), ('men', 'man'), ('ies', 'y')),
exceptions(token, fixed) as (values {", ".join(f"('{token}', '{lemma}')" for token, lemma in NOUN_EXCEPTIONS.items())}),
made as (select token, left(token, length(token) - length(suffix)) || ending as lemma
         from vocabulary join rules on ends_with(token, suffix) and length(token) > length(suffix)
         where not ends_with(token, 'ss')),
ruled as (select token, list(lemma order by length(lemma), lemma)[1] as best
          from made where lemma in (select token from vocabulary where n >= 2) group by token),
lemmas as (select token, coalesce(fixed, best) as lemma
           from vocabulary left join ruled using (token) left join exceptions using (token)
           where coalesce(fixed, best) <> token)"""

# Moments as power sums around the mean.
K2 = """
v as (select total_engagement as x from engaged),
mean as (select avg(x) as mu, count(*)::double as n from v),
power as (select max(n) as n, sum((x - mu) ** 2) / max(n) as m2, sum((x - mu) ** 3) / max(n) as m3,
                 sum((x - mu) ** 4) / max(n) as m4 from v, mean),
shape as (select n, m3 / m2 ** 1.5 as g1, m4 / m2 ** 2 as b2 from power),
skew as (
  select *, g1 * sqrt((n + 1) * (n + 3) / (6 * (n - 2))) as y,
         3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9)) as beta2 from shape),
skewz as (select *, sqrt(2 * (beta2 - 1)) - 1 as w2 from skew),
skewd as (select *, asinh(y / sqrt(2 / (w2 - 1))) / sqrt(0.5 * ln(w2)) as z1 from skewz),
kurt as (
  select *, (b2 - 3 * (n - 1) / (n + 1)) / sqrt(24 * n * (n - 2) * (n - 3) / ((n + 1) ** 2 * (n + 3) * (n + 5))) as x,
         6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3))) as s
  from skewd),
kurta as (select *, 6 + 8 / s * (2 / s + sqrt(1 + 4 / (s * s))) as a from kurt),
kurtz as (select *, (1 - 2 / a) / (1 + x * sqrt(2 / (a - 4))) as q from kurta),
z as (select *, (1 - 2 / (9 * a) - sign(q) * abs(q) ** (1.0 / 3)) / sqrt(2 / (9 * a)) as z2 from kurtz)
select cast(n as bigint) as n, round(g1, 6) + 0.0 as skewness, round(b2 - 3, 6) + 0.0 as kurtosis,
       round(z1 * z1 + z2 * z2, 3) + 0.0 as k2, round(exp(-(z1 * z1 + z2 * z2) / 2), 6) + 0.0 as p_value from z"""

# Shapiro-Wilk weights for more than five values, with the normal quantile by a rational approximation.
LOWER = """(((((-7.784894002430293e-03 * q - 3.223964580411365e-01) * q - 2.400758277161838) * q - 2.549732539343734) * q
  + 4.374664141464968) * q + 2.938163982698783) / ((((7.784695709041462e-03 * q + 3.224671290700398e-01) * q
  + 2.445134137142996) * q + 3.754408661907416) * q + 1)"""
MIDDLE = """(((((-39.69683028665376 * r + 220.9460984245205) * r - 275.9285104469687) * r + 138.3577518672690) * r
  - 30.66479806614716) * r + 2.506628277459239) * c / (((((-54.47609879822406 * r + 161.5858368580409) * r
  - 155.6989798598866) * r + 66.80131188771972) * r - 13.28068155288572) * r + 1)"""


def shapiro(column: str) -> str:
    return f"""
select '{column}' as name, count(*) as n, 'shapiro' as test,
       round(sum(a * v) ** 2 / sum((v - mean) ** 2), 6) + 0.0 as statistic
from (select place, v, mean, case when place = n then a1 when place = n - 1 then a2 when place = 1 then -a1
             when place = 2 then -a2 else m / sqrt((ss - 2 * m1 ** 2 - 2 * m2 ** 2) / (1 - 2 * a1 ** 2 - 2 * a2 ** 2)) end as a
      from (select *, m1 / sqrt(ss) + 0.221157 * u - 0.147981 * u ** 2 - 2.07119 * u ** 3 + 4.434685 * u ** 4 - 2.706056 * u ** 5 as a1,
                   m2 / sqrt(ss) + 0.042981 * u - 0.293762 * u ** 2 - 1.752461 * u ** 3 + 5.682633 * u ** 4 - 3.582633 * u ** 5 as a2
            from (select *, sum(m * m) over () as ss, max(m) over () as m1, 1 / sqrt(n) as u,
                         max(case when place = n - 1 then m end) over () as m2
                  from (select *, case when p < 0.02425 then {LOWER} when p > 0.97575 then -({LOWER}) else {MIDDLE} end as m
                        from (select *, sqrt(-2 * ln(least(p, 1 - p))) as q, p - 0.5 as c, (p - 0.5) ** 2 as r
                              from (select *, (place - 0.375) / (n + 0.25) as p
                                    from (select {column} as v, row_number() over (order by {column}) as place,
                                                 count(*) over () as n, avg({column}) over () as mean from metrics)))))))"""


ADAPTIVE = (
    spearman("volume_vs_engagement", "word_count", "reddit_engagement", "texts")
    + " union all "
    + spearman("influencer_virality", "coalesce(user_followers_count, 0)", "total_engagement", "texts")
)

TRANSFORMED = f"""
filled as (
  select *, case when data_source like '%reddit%' and subreddit = 'error' then 'technology'
                 when data_source like '%reddit%' then subreddit else 'unknown' end as community,
         coalesce(author, 'unknown') as known_author from texts),
stats as (select max(total_engagement) as top, avg(total_engagement) as me, stddev_samp(total_engagement) as se,
                 avg(word_count) as mw, stddev_samp(word_count) as sw from filled)
select id, data_source, community as subreddit, known_author as author, cast(word_count as integer) as word_count,
       coalesce(user_followers_count, 0) as user_followers_count, total_engagement,
       round(total_engagement / top, 6) + 0.0 as engagement_rate,
       round((total_engagement - me) / se, 6) + 0.0 as total_engagement_normalized,
       round((word_count - mw) / sw, 6) + 0.0 as word_count_normalized,
       case when compound > 0.05 then 'positive' when compound < -0.05 then 'negative' else 'neutral' end as sentiment_label
from filled, stats"""

ORACLES: dict[str, str] = {
    "csv_roundtrip": "select doc_id, lang, n_chars, cast(len(text) as integer) as chars from documents",
    "raw_folder": on_posts(
        "select 'first:reddit.parquet' as dataset, count(*) as count from posts where data_source <> 'twitter' "
        "union all select 'reddit.parquet', count(*) from posts where data_source <> 'twitter' "
        "union all select 'twitter.csv', count(*) from posts where data_source = 'twitter'"
    ),
    "run_folders": on_posts(
        "select '20240201_000000' as run_id, count(*) as total_posts, count(*) filter (data_source like '%reddit%') as "
        "reddit_posts, count(*) filter (data_source = 'twitter') as twitter_posts, sum(total_engagement) as "
        "total_engagement, sum(total_engagement) as reported_engagement from engaged"
    ),
    "combined_sources": on_posts(
        "select id, day, data_source, case when data_source = 'twitter' then null when subreddit = 'error' then "
        "'technology' else subreddit end as subreddit, case when data_source = 'twitter' then user_id end as user_id, "
        "author, retweet_count, score from posts"
    ),
    "imputed": on_posts(
        "select id, cast(len(coalesce(text, 'unknown')) as integer) as chars, "
        "case when data_source = 'twitter' then user_id else 'unknown' end as user_id, "
        "coalesce(author, 'unknown') as author, case when data_source = 'twitter' then 'unknown' when subreddit = 'error' "
        "then 'technology' else subreddit end as subreddit, coalesce(retweet_count, 0) as total_engagement, "
        "coalesce(user_followers_count, 0) as audience from posts"
    ),
    "filtered_posts": on_posts(
        "select id, data_source, subreddit from posts where day between date '2024-01-02' and date '2024-01-03' "
        "and len(text) > 10"
    ),
    "complete_pairs": on_posts("select score as x, comments as y from posts where score is not null and comments is not null"),
    "clean_text": f"select doc_id, {clean('text')} as text_cleaned from documents",
    "clean_pages": f"select page_id, {clean('html')} as text_cleaned from pages",
    "word_count": f"select doc_id, cast({words_in(clean('text'))} as integer) as word_count from documents",
    "nlp_normalise": f"select doc_id, array_to_string({token_list('text')}, ' ') as text_tokens_clean from documents",
    "nlp_pages": f"select page_id, array_to_string({token_list('html')}, ' ') as text_tokens_clean from pages",
    "lemmatised": f"with {PLURALS}",
    "lemmatised_join": f"with {PLURALS}",
    "noun_lemmas": f"with {NOUNS} select token, lemma from lemmas",
    "lemmatised_nouns": f"with {NOUNS}, {PLACED}",
    "domain_tags": f"select doc_id, {TAGS.replace('{0}', clean('text'))} as tech_keywords from documents",
    "parsed_times": (
        "select event_id, case event_id % 3 when 2 then null else strftime(ts, '%Y-%m-%d %H:%M:%S') end as iso, "
        "cast(event_id as integer) as unix_days from events"
    ),
    "engagement_features": on_posts(
        "select id, coalesce(user_followers_count, 0) as user_followers_count, twitter_engagement, reddit_engagement, "
        "total_engagement, round(total_engagement / (select max(total_engagement) from texts), 6) + 0.0 as engagement_rate, "
        "round((total_engagement - (select avg(total_engagement) from texts)) / "
        "(select stddev_samp(total_engagement) from texts), 6) + 0.0 as total_engagement_normalized, "
        "round((word_count - (select avg(word_count) from texts)) / (select stddev_samp(word_count) from texts), 6) + 0.0 "
        "as word_count_normalized from texts",
        POST_TEXTS,
    ),
    "sentiment_score": f"with {scored(LEXICON, BOOSTERS, NEGATORS, DOCUMENT_SOURCE)} select id as doc_id, "
    f"compound as sentiment_compound, case when compound > 0.05 then 'positive' when compound < -0.05 then 'negative' "
    f"else 'neutral' end as label_strict, {LABEL.format('compound')} as sentiment_label, compound as sentiment_polarity "
    "from scores",
    "sentiment_rules": f"with {scored(RULE_LEXICON, RULE_BOOSTERS, RULE_NEGATORS, DOCUMENT_SOURCE)} "
    "select id as doc_id, compound as sentiment_compound from scores",
    "source_detection": (
        "select * from (values ('twitter', 'twitter', 3, 'created_at'), ('twitter', 'twitter', 1, ''), "
        "('reddit_kaggle', 'unknown', 3, ''), ('reddit_kaggle', 'unknown', 1, ''), "
        "('events', 'twitter', 3, 'text'), ('events', 'twitter', 1, '')) as t(dataset, source, rules, missing) "
        "where (select count(*) from events) > 0"
    ),
    "quality_profile": on_posts(
        """
select 'score' as "column", count(*) as "rows", round(avg((score is null)::int), 6) + 0.0 as null_share,
       round(stddev_samp(score), 6) + 0.0 as spread, min(score) = max(score) as constant, null::date as first_day,
       null::date as last_day, null::bigint as out_of_range from posts
union all select 'retweet_count', count(*), round(avg((retweet_count is null)::int), 6) + 0.0,
       round(stddev_samp(retweet_count), 6) + 0.0, min(retweet_count) = max(retweet_count), null, null, null from posts
union all select 'user_followers_count', count(*), round(avg((user_followers_count is null)::int), 6) + 0.0,
       round(stddev_samp(user_followers_count), 6) + 0.0, min(user_followers_count) = max(user_followers_count),
       null, null, null from posts
union all select 'created_at', count(*), 0.0, null, null, min(day), max(day),
       count(*) filter (created_at < '2024-01-05' or created_at > '2024-01-20') from posts"""
    ),
    "quality_issues": on_posts(
        """
select 'nulls' as "check", c as "column", round(s, 6) + 0.0 as value from (
  select 'score' as c, avg((score is null)::int) as s from posts
  union all select 'retweet_count', avg((retweet_count is null)::int) from posts
  union all select 'user_followers_count', avg((user_followers_count is null)::int) from posts) where s > 0.4
union all select 'variance', 'author_post_karma', 0.0
union all select 'future_dates', 'created_at', year(max(created_at))::double from posts having max(created_at) > '2024-01-16'
union all select 'date_range', 'created_at', count(*)::double from posts where created_at < '2024-01-05' or created_at > '2024-01-20'"""
    ),
    "validation_report": on_posts(
        # Only the third table has a time column by the name that is looked for.
        "select dataset, source, status, missing, coalesce(string_agg(issue, '; ' order by issue), '') as issues, 'FAILED' as overall_status "
        "from (values ('twitter', 'twitter', 'FAILED', 'created_at'), ('reddit_kaggle', 'reddit', 'PASSED', ''), "
        "('twitter_feed', 'twitter', 'PASSED', '')) as t(dataset, source, status, missing) left join ("
        "select dataset, 'nulls:text:' || cast(cast(share as decimal(20, 4)) as varchar) || ':' || printf('%.1f%%', share * 100) "
        "|| ' missing' as issue from (select unnest(case when data_source = 'twitter' then ['twitter', 'twitter_feed'] else [data_source] end) "
        "as dataset, avg(case when text is null or (data_source = 'reddit_kaggle' and subreddit = 'view') then 1.0 else 0.0 end) as share "
        "from posts group by 1, data_source) where share > 0.1 "
        "union all select 'twitter_feed', 'future_dates:created_at:' || cast(cast(year(m) as decimal(20, 4)) as varchar) || ':latest ' || "
        "cast(m as varchar) from (select max(created_at) as m from posts where data_source = 'twitter') where m > timestamp '2024-01-11' "
        "union all select 'twitter_feed', 'date_range:created_at:' || cast(cast(n as decimal(20, 4)) as varchar) || ':rows outside the "
        "allowed date range' from (select count(*) as n from posts where data_source = 'twitter' and (created_at < timestamp '2024-01-05' or "
        "created_at > timestamp '2024-01-20')) where n > 0) using (dataset) group by all"
    ),
    "sentiment_grid": on_posts(
        "select data_source, sentiment_bin, engagement_bin, count(*) as count, arg_min(id, k) as id, arg_min(compound, k) as sentiment_compound, "
        "arg_min(total_engagement, k) as total_engagement from (select *, least(40, floor((compound + 1) / 2 * 40) + 1)::integer as sentiment_bin, "
        "floor(log2(total_engagement + 1))::integer as engagement_bin, md5('42|' || id) as k from texts) group by all",
        POST_TEXTS,
    ),
    "sentiment_table": "with "
    + scored({}, BOOSTERS, NEGATORS, DOCUMENT_SOURCE).replace(
        "lexicon(word, value) as (values )",
        "lexicon as (select word, value from (select word, (('0x' || substr(md5(word), 1, 4))::integer % 81 - 40) / 10.0::double as value "
        "from (select distinct unnest(regexp_split_to_array(cleaned, '[^a-z0-9áéíóúñü]+')) as word from src) where len(word) > 3) where value <> 0)",
    )
    + f" select id as doc_id, compound as sentiment_compound, {LABEL.format('compound')} as sentiment_label from scores",
    "sentiment_distribution": on_posts(
        "select sentiment_label, count(*) as count from texts group by sentiment_label", POST_TEXTS
    ),
    "platform_summary": on_posts(
        "select data_source, round(avg(polarity), 4) + 0.0 as sentiment_polarity_mean, round(stddev_samp(polarity), 4) + 0.0 "
        "as sentiment_polarity_std, count(polarity) as sentiment_polarity_count, round(avg(total_engagement), 4) + 0.0 as "
        "total_engagement_mean, round(sum(total_engagement), 4) + 0.0 as total_engagement_sum, "
        "round(median(total_engagement), 4) + 0.0 as total_engagement_median from polar group by data_source",
        POST_TEXTS,
    ),
    "domain_engagement": on_posts(
        "select domain, count(*) as count, round(avg(total_engagement), 4) + 0.0 as mean_engagement, "
        "round(avg(compound), 4) + 0.0 as mean_sentiment from texts join (values "
        + ", ".join(f"('{d}')" for d in DOMAINS)
        + ") as d(domain) on contains(text_cleaned, lower(domain)) group by domain",
        POST_TEXTS,
    ),
    "daily_metrics": on_posts(
        "select day, round(sentiment_polarity, 6) + 0.0 as sentiment_polarity, total_engagement, reddit_engagement, word_count from metrics",
        DAILY_METRICS,
    ),
    "daily_gaps": on_posts(
        "select days.day, coalesce(count, 0) as count from days left join daily using (day)",
        calendar(
            "select day + case when day(created_at) % 4 = 2 then 90 else 0 end as day, count(*) as count from posts group by 1"
        ),
    ),
    "daily_describe": on_posts(
        " union all ".join(
            f"select '{c}' as \"column\", count({c}) as count, round(avg({c}), 4) + 0.0 as mean, round(stddev_samp({c}), 4) + 0.0 as std, "
            f"round(min({c}), 4) + 0.0 as min, round(quantile_cont({c}, 0.25), 4) + 0.0 as q25, round(quantile_cont({c}, 0.5), 4) + 0.0 "
            f"as q50, round(quantile_cont({c}, 0.75), 4) + 0.0 as q75, round(max({c}), 4) + 0.0 as max from metrics"
            for c in ("sentiment_polarity", "total_engagement", "reddit_engagement", "word_count")
        ),
        DAILY_METRICS,
    ),
    "daily_volume_by_source": on_posts("select day, data_source, count(*) as count from posts group by all"),
    "daily_sentiment": on_posts(
        "select days.day, round(m, 6) + 0.0 as mean_sentiment from days left join daily using (day)",
        POST_TEXTS + ", " + calendar("select day, avg(polarity) as m from polar group by day"),
    ),
    "daily_volume": on_posts(
        "select days.day, coalesce(count, 0) as count from days left join daily using (day)",
        calendar("select day, count(*) as count from posts group by day"),
    ),
    "kpis": on_posts(
        "select count(*) as total_posts, count(*) filter (data_source like '%reddit%') as reddit_posts, "
        "count(*) filter (data_source = 'twitter') as twitter_posts, sum(total_engagement) as total_engagement from engaged"
    ),
    "top_categories": on_posts(
        "select subreddit, count(*) as posts from posts group by subreddit order by posts desc, subreddit limit 10"
    ),
    "top_posts": on_posts(
        "select id, created_at, subreddit, text_cleaned, total_engagement, sentiment_label from polar "
        "order by total_engagement desc, id limit 50",
        POST_TEXTS,
    ),
    "histogram": on_posts(
        "select cast(least(30, 1 + floor((total_engagement - lo) * 30 / (hi - lo))) as integer) as bin, count(*) as count "
        "from engaged, (select min(total_engagement) as lo, max(total_engagement) as hi from engaged) group by bin"
    ),
    "top_users": on_posts(
        "select user_id, sum(total_engagement) as total_engagement from engaged group by user_id "
        "order by total_engagement desc, user_id limit 10"
    ),
    "platform_pivot": on_posts(
        "select day as time, round(avg(total_engagement) filter (data_source = 'reddit_kaggle'), 6) + 0.0 as reddit_kaggle, "
        "round(avg(total_engagement) filter (data_source = 'twitter'), 6) + 0.0 as twitter from engaged group by day "
        "having count(distinct data_source) = 2"
    ),
    "platform_pivot_exact": on_posts(
        "select strftime(date_trunc('minute', created_at), '%Y-%m-%d %H:%M') as time, "
        "round(avg(total_engagement) filter (data_source = 'reddit_kaggle'), 6) + 0.0 as reddit_kaggle, "
        "round(avg(total_engagement) filter (data_source = 'twitter'), 6) + 0.0 as twitter from engaged group by time "
        "having count(distinct data_source) = 2"
    ),
    "distinct_users": on_posts("select distinct user_id from posts"),
    "date_extent": on_posts("select min(day) as first_day, max(day) as last_day from posts"),
    "sentiment_points": on_posts(
        "select id, data_source, round(polarity, 6) + 0.0 as sentiment_compound, total_engagement, "
        "cast(word_count as integer) as word_count from polar",
        POST_TEXTS,
    ),
    "length_points": on_posts(
        "select id, data_source, cast(word_count as integer) as word_count, round(compound, 6) + 0.0 as sentiment_compound "
        "from texts order by md5('42|' || id) limit 1000",
        POST_TEXTS,
    ),
    "seeded_sample": on_posts("select id, data_source from posts order by md5('42|' || id) limit 3000"),
    "normality_moments": on_posts("", K2),
    "normality_gate": on_posts(
        "select name, n, case when n < 5000 then 'shapiro' else 'normaltest' end as test, false as is_normal from ("
        "select 'total_engagement' as name, count(*) as n from engaged "
        "union all select 'comments', count(comments) from engaged)"
    ),
    "pearson": on_posts(
        "select count(*) as n, round(corr(total_engagement, user_followers_count), 6) + 0.0 as correlation from engaged "
        "where user_followers_count is not null"
    ),
    "spearman": on_posts("select n, correlation from (" + spearman("", "score", "comments", "posts") + ")"),
    "kendall": on_posts(
        """
select n, c as concordant, pairs - tx - ty + txy - c as discordant, tx as x_tied_pairs, ty as y_tied_pairs,
       round((c - (pairs - tx - ty + txy - c)) / (sqrt(pairs - tx) * sqrt(pairs - ty)), 6) + 0.0 as correlation
from (select sum(n) as n, sum(n) * (sum(n) - 1) / 2.0 as pairs, sum(n * (n - 1) / 2.0) as txy from cells),
     (select sum(n * (n - 1) / 2.0) as tx from (select sum(n) as n from cells group by x)),
     (select sum(n * (n - 1) / 2.0) as ty from (select sum(n) as n from cells group by y)),
     (select sum(a.n * b.n)::double as c from cells a join cells b on a.x < b.x and a.y < b.y)""".replace(
            "select n, c as", "select cast(n as bigint) as n, c as"
        ),
        "cells as (select score as x, comments as y, count(*)::double as n from posts where score is not null group by all)",
    ),
    "adaptive_correlation": on_posts(reported(ADAPTIVE), POST_TEXTS),
    "sentiment_correlations": on_posts(
        reported(" union all ".join(
            spearman(f"{s}_vs_{e}", "polarity", e, "polar")
            for s in ("sentiment_compound", "sentiment_polarity")
            for e in ("twitter_engagement", "reddit_engagement", "total_engagement")
        )),
        POST_TEXTS,
    ),
    "levene": on_posts(
        "select k, n, round(statistic, 6) + 0.0 as statistic from f",
        "medians as (select subreddit as g, median(total_engagement) as m from engaged group by subreddit), "
        + f_ratio(
            "select subreddit as g, abs(total_engagement - m) as v from engaged join medians on medians.g = subreddit "
            f"where subreddit in {TYPES}"
        ),
    ),
    "anova": on_posts(
        "select k, n, round(statistic, 6) + 0.0 as statistic from f",
        f_ratio(f"select subreddit as g, total_engagement as v from engaged where subreddit in {TYPES}"),
    ),
    "kruskal": on_posts(
        "select cast(k as integer) as k, n, round(statistic, 6) + 0.0 as statistic from h",
        kruskal(f"select subreddit as g, total_engagement as v from engaged where subreddit in {TYPES}"),
    ),
    "sentiment_comparison": on_posts(
        # With three groups the tails of chi-square and F have closed forms.
        "select 'sentiment_engagement_comparison' as name, round(statistic, 4) + 0.0 as statistic, "
        "round(p, 4) + 0.0 as p_value, test_used, p < 0.05 as significant from ("
        "select 'Kruskal-Wallis (Heteroscedastic)' as test_used, statistic, exp(-statistic / 2) as p, true as unequal from h "
        "union all select 'ANOVA (Fisher)', statistic, pow(1 + 2 * statistic / (n - k), -(n - k) / 2.0), false from f_anova) "
        "where unequal = (select pow(1 + 2 * statistic / (n - k), -(n - k) / 2.0) < 0.05 from f_levene)",
        POST_TEXTS
        + ", "
        + kruskal("select sentiment_label as g, total_engagement as v from polar")
        + ", medians as (select sentiment_label as g, median(total_engagement) as m from polar group by 1), "
        + f_ratio("select sentiment_label as g, total_engagement as v from polar", "_anova")
        + ", "
        + f_ratio(
            "select sentiment_label as g, abs(total_engagement - m) as v from polar join medians on medians.g = sentiment_label",
            "_levene",
        ),
    ),
    "welch": on_posts(
        """
select n1, n2, round((m1 - m2) / sqrt(v1 / n1 + v2 / n2), 4) + 0.0 as statistic,
       round((v1 / n1 + v2 / n2) ** 2 / ((v1 / n1) ** 2 / (n1 - 1) + (v2 / n2) ** 2 / (n2 - 1)), 4) + 0.0 as df
from (select count(*) filter (t) as n1, count(*) filter (not t) as n2, avg(v) filter (t) as m1, avg(v) filter (not t) as m2,
             var_samp(v) filter (t) as v1, var_samp(v) filter (not t) as v2
      from (select data_source = 'twitter' as t, total_engagement as v from engaged))"""
    ),
    "mann_whitney": on_posts(
        "select n1, n2, round(statistic, 1) + 0.0 as statistic, round(ties.t, 1) + 0.0 as ties from u, ties",
        mann_whitney("select data_source as g, total_engagement as v from engaged"),
    ),
    "platform_comparison": on_posts(
        "select 'platform_engagement_comparison' as name, round(statistic, 1) + 0.0 as statistic, round(p, 6) + 0.0 as p_value, "
        f"'Mann-Whitney U' as test_used, p < 0.05 as significant from (select *, {normal_p('z')} as p from (select *, "
        "(greatest(statistic, n1::double * n2 - statistic) - n1::double * n2 / 2 - 0.5) / sqrt(n1::double * n2 / 12 * (n1 + n2 + 1 "
        "- t / ((n1 + n2)::double * (n1 + n2 - 1)))) as z from u, ties))",
        mann_whitney("select data_source as g, total_engagement as v from engaged"),
    ),
    "adf_lag0": on_posts(
        " union all ".join(
            f"select '{c}' as \"column\", round(b / sqrt((syy - b * b * sxx) / (n - 2) / sxx), 6) + 0.0 as test_statistic, "
            "0::integer as lags, n from (select regr_slope(d, y) as b, regr_sxx(d, y) as sxx, regr_syy(d, y) as syy, "
            f"count(*) as n from (select {c} - lag({c}) over (order by day) as d, lag({c}) over (order by day) as y from metrics) "
            "where d is not null)"
            for c in ("sentiment_polarity", "total_engagement", "reddit_engagement", "word_count")
        ),
        DAILY_METRICS,
    ),
    "vocabulary": (
        f"select term, count(*) as documents from (select unnest(list_distinct({token_list('text')})) as term from documents) "
        "group by term having count(*) >= 2 and count(*) <= 0.95 * (select count(*) from documents)"
    ),
    "seasonal": on_posts("", seasonal(False)),
    "seasonal_multiplicative": on_posts("", seasonal(True)),
    "reddit_volume": on_posts(
        reported(spearman("volume_vs_engagement", "word_count", "reddit_engagement", "texts", "data_source like '%reddit%'")),
        POST_TEXTS,
    ),
    "shapiro": on_posts(
        " union all ".join(shapiro(c) for c in ("sentiment_polarity", "total_engagement", "reddit_engagement", "word_count")),
        DAILY_METRICS,
    ),
    "cross_platform": on_posts(
        reported("select 'reddit_kaggle_vs_twitter' as name, count(*) as n, corr(a, b) as correlation, "
        "'pearson' as method_used from (select avg(total_engagement) filter (data_source = 'reddit_kaggle') as a, "
        "avg(total_engagement) filter (data_source = 'twitter') as b from engaged group by day) "
        "where a is not null and b is not null")
    ),
    "findings": on_posts(
        "select 'completed' as status, count(*) as correlations, 2::bigint as statistical_tests, "
        "(select count(*) from (values "
        + ", ".join(f"('{d}')" for d in DOMAINS)
        + ") as d(domain) where exists (select 1 from texts where contains(text_cleaned, lower(domain)))) as domains_analyzed, "
        "coalesce(string_agg('Correlation ' || name || ' is significant (p=' || printf('%.4f', p) || ') using ' || method_used, '; ' "
        "order by 'Correlation ' || name) filter (p < 0.05), '') as significant_findings from "
        f"(select *, {correlation_p('correlation', 'n')} as p from ("
        + spearman("volume_vs_engagement", "word_count", "reddit_engagement", "texts")
        + " union all "
        + spearman("influencer_virality", "user_followers_count", "total_engagement", "texts")
        + "))",
        POST_TEXTS,
    ),
    "community_edges": on_posts("select * from edges", COMMUNITY),
    "community_nodes": on_posts("select * from nodes", COMMUNITY),
    "reply_edges": on_posts("select src, dst, 1.0::double as weight from redges", REPLIES),
    "graph_metrics": on_posts(
        " union all ".join(
            f"select '{name}' as graph, n as number_of_nodes, e as number_of_edges, round(2 * e / n::double, 6) + 0.0 as "
            f"average_degree, round(2 * e / (n * (n - 1))::double, 6) + 0.0 as density from "
            f"(select count(*) as n from {nodes}), (select count(*) as e from {edges})"
            for name, nodes, edges in (("community", "nodes", "edges"), ("replies", "rnodes", "redges"))
        ),
        f"{COMMUNITY}, {REPLIES}",
    ),
    "degree_centrality": on_posts("select * from central", REPLIES),
    "top_central": on_posts("select * from central order by degree desc, id limit 10", REPLIES),
    "pagerank_10": pagerank(10),
    "sentiment_alerts": on_posts(
        "select day, round(m, 6) + 0.0 as mean_sentiment from (select days.day, m from days left join daily using (day) "
        "order by days.day desc limit 3) where m < 0.01",
        POST_TEXTS + ", " + calendar("select day, avg(polarity) as m from polar group by day"),
    ),
    "volume_alerts": on_posts(
        "select day, count, round(lim, 6) + 0.0 as \"limit\" from filled, (select avg(count) + stddev_samp(count) as lim, "
        "count(*) as n from filled) where n > 5 and count > lim",
        calendar("select day, count(*) as count from posts group by day")
        + ", filled as (select days.day, coalesce(count, 0) as count from days left join daily using (day))",
    ),
    "weak_correlations": on_posts(
        f"select name, round(correlation, 6) + 0.0 as correlation from ({ADAPTIVE}) where abs(correlation) < 0.3", POST_TEXTS
    ),
    "control_limits": on_posts(
        "select round(avg(n), 6) + 0.0 as centre_line, round(avg(n) + 2 * stddev_samp(n), 6) + 0.0 as upper_limit "
        "from (select count(*) as n from posts group by day, data_source)"
    ),
    "daily_stream": on_posts(
        "select data_source, count(*) as count, round(sum(value), 4) + 0.0 as total_engagement, round(avg(polarity), 6) + 0.0 as "
        f"mean_sentiment, day from polar join events using (event_id) where {CLOSED} group by all",
        POST_TEXTS,
    ),
    "sentiment_drop_stream": on_posts(
        f"select * from (select day, data_source, round(avg(polarity), 6) + 0.0 as mean_sentiment from polar where {CLOSED} group by all) "
        "where mean_sentiment < 0.01",
        POST_TEXTS,
    ),
    "watch_stream": on_posts(
        WATCHED, POST_TEXTS + ", " + watched("(select cast(max(ts) - interval 2 day as date) - 1 from events)")
    ),
    "daily_watch": on_posts(WATCHED, POST_TEXTS + ", " + watched("(select max(day) from posts)")),
    "rollups_over_runs": on_posts(
        "select part, item, figure, round(value, 6) + 0.0 as value from ("
        + " union all ".join(
            f"select '{part}' as part, {item} as item, '{name}' as figure, ({figure})::double as value from {source}"
            for part, item, source, names in (
                ("platform_summary", "data_source", "polar group by data_source", (
                    ("sentiment_polarity_mean", "round(avg(polarity), 4)"), ("sentiment_polarity_std", "round(stddev_samp(polarity), 4)"),
                    ("sentiment_polarity_count", "count(polarity)"), ("total_engagement_mean", "round(avg(total_engagement), 4)"),
                    ("total_engagement_sum", "round(sum(total_engagement), 4)"), ("total_engagement_median", "round(median(total_engagement), 4)"),
                )),
                ("daily_metrics", "day::varchar", "metrics", tuple(
                    (c, c) for c in ("sentiment_polarity", "total_engagement", "reddit_engagement", "word_count")
                )),
                ("daily_volume_by_source", "day || ' ' || data_source", "posts group by day, data_source", (("count", "count(*)"),)),
                ("kpis", "''", "engaged", (
                    ("total_posts", "count(*)"), ("reddit_posts", "count(*) filter (data_source like '%reddit%')"),
                    ("twitter_posts", "count(*) filter (data_source = 'twitter')"), ("total_engagement", "sum(total_engagement)"),
                )),
            )
            for name, figure in names
        )
        + ")",
        DAILY_METRICS,
    ),
    "monitoring_read": on_posts(
        "select '20240101_000000' as run_id, part, item, round(value, 4) + 0.0 as value from ("
        "select 'kpis' as part, 'total_posts' as item, count(*)::double as value from near "
        "union all select 'kpis', 'reddit_posts', count(*) from near where data_source = 'reddit_kaggle' "
        "union all select 'kpis', 'twitter_posts', count(*) from near where data_source = 'twitter' "
        "union all select 'kpis', 'total_engagement', sum(total_engagement) from near "
        "union all select 'daily_volume', day || ' ' || data_source, count(*) from near group by day, data_source "
        "union all select 'top_categories', subreddit, count(*) from reddit group by subreddit "
        "union all select 'histogram', least(30, 1 + floor((total_engagement - lo) * 30 / (hi - lo)))::integer::varchar, count(*) "
        "from reddit, (select min(total_engagement) as lo, max(total_engagement) as hi from reddit) group by 2 "
        "union all (select 'top_posts', id, total_engagement from reddit order by total_engagement desc, id limit 50) "
        "union all select 'alerts', 'critical: sentiment drop: ' || string_agg(day::varchar, ', ' order by day), 1 from "
        "(select day, avg(polarity) as m from near group by day order by day desc limit 3) where m < 0.01 having count(*) > 0)",
        POST_TEXTS + ", near as (select * from polar where day between date '2024-01-02' and date '2024-01-03'), "
        "reddit as (select * from near where data_source = 'reddit_kaggle')",
    ),
    "analysis_job": on_posts(
        "select section, item, figure, round(value, 4) + 0.0 as value from ("
        + " union all ".join(
            [
                f"select 'correlations' as section, name as item, unnest(['n', 'correlation', 'p_value']) as figure, "
                f"unnest([n::double, correlation, {correlation_p('correlation', 'n')}]) as value from ("
                + spearman("volume_vs_engagement", "word_count", "reddit_engagement", "texts")
                + " union all "
                + spearman("influencer_virality", "user_followers_count", "total_engagement", "texts")
                + ")",
                "select 'cross_platform', data_source, unnest(['total_engagement_mean', 'total_engagement_sum', 'total_engagement_median']), "
                "unnest([avg(total_engagement), sum(total_engagement), median(total_engagement)]) from polar group by data_source",
                "select 'technology_domains', domain, unnest(['count', 'mean_engagement', 'mean_sentiment']), "
                "unnest([count(*)::double, avg(total_engagement), avg(compound)]) from texts join (values "
                + ", ".join(f"('{d}')" for d in DOMAINS)
                + ") as d(domain) on contains(text_cleaned, lower(domain)) group by domain",
                *(
                    f"select 'daily_summary', '{c}', unnest(['count', 'mean', 'std', 'min', 'q25', 'q50', 'q75', 'max']), "
                    f"unnest([count({c})::double, avg({c}), stddev_samp({c}), min({c})::double, quantile_cont({c}, 0.25)::double, "
                    f"quantile_cont({c}, 0.5)::double, quantile_cont({c}, 0.75)::double, max({c})::double]) from metrics"
                    for c in ("sentiment_polarity", "total_engagement", "reddit_engagement", "word_count")
                ),
                "(select 'top_users', user_id, 'total_engagement', sum(total_engagement) as e from engaged group by user_id "
                "order by e desc, user_id limit 10)",
                "select 'community_metrics', 'community', unnest(['number_of_nodes', 'number_of_edges', 'average_degree', 'density']), "
                "unnest([n::double, e::double, 2 * e / n::double, 2 * e / (n * (n - 1))::double]) from "
                "(select count(*) as n from nodes), (select count(*) as e from edges)",
                "select 'summary', 'completed', unnest(['correlations', 'statistical_tests', 'domains_analyzed']), unnest([2.0, 1.0, "
                "(select count(*) from (values "
                + ", ".join(f"('{d}')" for d in DOMAINS)
                + ") as d(domain) where exists (select 1 from texts where contains(text_cleaned, lower(domain))))::double])",
            ]
        )
        + ")",
        f"{DAILY_METRICS}, {COMMUNITY}",
    ),
    "stored_job": on_posts(
        "select 'posts' as part, data_source as item, unnest(['posts', 'total_engagement', 'word_count']) as figure, "
        "unnest([count(*)::double, sum(total_engagement)::double, sum(word_count)::double]) as value from texts group by data_source "
        "union all select 'sentiment_distribution', sentiment_label, 'count', count(*)::double from texts group by sentiment_label "
        "union all select 'validation_status', 'FAILED', 'datasets', 2.0",
        POST_TEXTS,
    ),
    "influencers_20": pagerank(
        20,
        "select id, round(rank, 8) + 0.0 as rank_score, coalesce(source, 'unknown') as source, coalesce(followers, 0.0) as followers "
        "from (select * from {last} order by rank desc, id limit 10) join nodes using (id) where type = 'user'",
    ),
    "topic_terms": topic_model(3, 10, 0)
    + " union all ".join(
        f" select {i}::integer as topic, 'Topic {i}: ' || string_agg(term, ', ' order by w desc, term) as label from "
        f"(select term, round(w{i}, 9) as w from w10 order by w desc, term limit 5)"
        for i in range(3)
    ),
    "dominant_topics": topic_model(3, 10, 3)
    + " select doc_id, case when len(array_to_string(ws, ' ')) > 10 then coalesce(list_position(l, list_max(l)) - 1, 0) end::integer as "
    "dominant_topic from documents join toks on toks.text = doc_id left join (select text, [round(t0, 9), round(t1, 9), round(t2, 9)] as l "
    "from f3) fitted on fitted.text = doc_id",
    "transform_job": on_posts("", POST_TEXTS + "," + TRANSFORMED),
    "nlp_job": f"with {scored(LEXICON, BOOSTERS, NEGATORS, DOCUMENT_SOURCE)} select id, "
    f"array_to_string({token_list('text')}, ' ') as text_tokens_clean, {LABEL.format('compound')} as sentiment_label, "
    f"{TAGS.replace('{0}', 'cleaned')} as tech_keywords from documents join src on src.id = doc_id join scores using (id)",
}
