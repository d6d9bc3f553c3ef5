"""What the registered queries must return, as DuckDB SQL over the same tables.

The texts of the SQL are written on their own: the tokenizer rewrites the text rule by
rule where the Spark side looks for tokens in one pass, and paragraphs are nested with
window functions.
"""

from __future__ import annotations

from newstide.functions.porter import CVC, HAS_VOWEL, IRREGULAR, M_OVER_0, M_OVER_1, STEP_2, STEP_3, STEP_4
from newstide.functions.tokens import ENGLISH_STOP_WORDS, FUSED_WORDS
from newstide.schemas import FEATURES, TARGETS

RUN_DAY = "date '2024-01-16'"


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def listed(values) -> str:
    return ", ".join(text(v) for v in values)


def published(n: str) -> str:
    return f"cast(date '2024-01-01' + cast({n} % 29 as int) as date)"


ARTICLES = f"""
articles as (
  select doc_id, sha256(title || '|' || symbol || '|' || strftime(pub_date, '%Y-%m-%d')) as guid,
         symbol, pub_date, title, text
  from (select doc_id, source as symbol, {published("doc_id")} as pub_date,
               split_part(text, chr(10), 1) as title, text
        from documents))"""

ONCE = "once as (select * from articles where doc_id in (select min(doc_id) from articles group by guid))"

COUNTS = f"""
classified as (
  select d.doc_id, d.source as symbol, {published("d.doc_id")} as pub_date, l.quality = 1 as positive
  from documents d join labels l on d.doc_id = l.doc_id),
counts as (
  select symbol, pub_date, cast(count(*) filter (positive) as bigint) as pos_n,
         cast(count(*) filter (not positive) as bigint) as neg_n
  from classified group by symbol, pub_date)"""

INDICATORS = """
daily as (
  select symbol, pub_date, pos_n, neg_n, b,
         case when b > 0 then 'positive' when b < 0 then 'negative' else 'neutral' end as sentiment,
         b * ln(1 + pos_n + neg_n) as b_all, 1 - sqrt(1 - b * b) as agree
  from (select *, cast(pos_n - neg_n as double) / (pos_n + neg_n) as b from counts))"""

DAILY = f"{COUNTS}, {INDICATORS}"
ROUNDED = """round(b, 6) as bullish_indicator, round(b_all, 6) as bullish_indicator_all_posts,
       round(agree, 6) as agreement_indicator"""
DAILY_ROWS = f"select symbol, pub_date, pos_n, neg_n, sentiment, {ROUNDED} from daily"

TICKS = """
ticks as (
  select concat('src', cast(user_id % 20 as varchar)) as symbol, ts, value as price, event_type,
         cast(json_extract_string(props, '$.k') as double) as volume, event_id as seq
  from events)"""


def bars(source: str = "ticks") -> str:
    return f"""
  select symbol, cast(ts as date) as bar_date, arg_min(price, seq) as open, max(price) as high,
         min(price) as low, arg_max(price, seq) as close, round(sum(volume), 6) as volume
  from {source} group by 1, 2"""


BARS = f"{TICKS}, bars as ({bars()})"
MATCHED = f"""{DAILY}, {BARS},
matched as (
  select d.*, x.open, x.high, x.low, x.close, x.volume
  from daily d join bars x on d.symbol = x.symbol and d.pub_date + 1 = x.bar_date)"""
ENCODED = f"""{MATCHED},
encoded as (
  select symbol, pub_date, case when sentiment = 'positive' then 1 else 0 end as sentiment,
         b as bullish_indicator, b_all as bullish_indicator_all_posts, agree as agreement_indicator,
         open, high, low, close, volume
  from matched)"""

# --- text ---------------------------------------------------------------------------------

SPACE = r"\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}"
EDGE = r"([^\p{L}\p{N}_]|$)"
RULES = [
    (rf"[{SPACE}]+", " "),
    (r"\.{2,}", " "),
    (r"\.([ )\";}\]*:@'({\[]|$)", r" \1"),
    (r"'([^\P{L}mtsdnMTSDN]|[\p{N}_])" + EDGE, r"' \1\2"),
    (r"[:,]([^\p{Nd}])", r" \1"),
    (r"[:,]$", " "),
    (r"[;@#$%&?!*\"«“‘„`»”’\[\](){}<>]|--|''", " "),
    (r"'( |$)", r" \1"),
    (r"([^' ])('[sSmMdD]|'ll|'LL|'re|'RE|'ve|'VE|n't|N'T)( |$)", r"\1 \3"),
    (r" ", "  "),
    (r"^|$", " "),
] + [(rf"(?i) ({a})({b}) ", r" \1  \2 ") for a, b in FUSED_WORDS.values()]


def separated(column: str) -> str:
    for pattern, replacement in RULES:
        column = f"regexp_replace({column}, {text(pattern)}, {text(replacement)}, 'g')"
    return column


def word_list(column: str) -> str:
    return f"""list_filter(string_split_regex(lower({separated(column)}), ' +'), lambda w:
      regexp_full_match(w, '[\\p{{L}}\\p{{N}}]+') and not starts_with(w, 'http')
      and not list_contains([{listed(ENGLISH_STOP_WORDS)}], w))"""


# one row per content word of a document, numbered in order
WORDS = f"""
word_lists as (select doc_id, {word_list("text")} as words from documents),
words as materialized (
  select doc_id, unnest(words) as token, generate_subscripts(words, 1) as place from word_lists)"""


def cut(n) -> str:
    return f"left(w, len(w) - {n})"


def has(expression: str, pattern: str) -> str:
    return f"regexp_matches({expression}, {text(pattern)})"


def table_step(table: dict[str, str], measure: str, first: str = "") -> str:
    branches = " ".join(
        f"when ends_with(w, {text(old)}) then case when {has(cut(len(old)), measure)} "
        f"then {cut(len(old))} || {text(new)} else w end"
        for old, new in sorted(table.items(), key=lambda kv: -len(kv[0]))
    )
    return f"case {first} {branches} else w end"


DOUBLE = f"(right(w, 1) = left(right(w, 2), 1) and len(w) > 1 and {has('w', '[^aeiouy]$|[^aeiouy]yy$')})"
STEM_STEPS = [
    f"""case when ends_with(w, 'ies') and len(w) = 4 then {cut(1)}
      when ends_with(w, 'sses') or ends_with(w, 'ies') then {cut(2)}
      when ends_with(w, 'ss') then w when ends_with(w, 's') then {cut(1)} else w end""",
    f"""case when ends_with(w, 'ied') then case when len(w) = 4 then {cut(1)} else {cut(2)} end
      when ends_with(w, 'eed') then case when {has(cut(3), M_OVER_0)} then {cut(1)} else w end
      when ends_with(w, 'ed') and {has(cut(2), HAS_VOWEL)} then {cut(2)} || '#'
      when ends_with(w, 'ing') and {has(cut(3), HAS_VOWEL)} then {cut(3)} || '#' else w end""",
    "case when ends_with(w, '#') then '#' || left(w, len(w) - 1) else w end",
    f"""case when left(w, 1) <> '#' then w
      when {has("w", "(at|bl|iz)$")} then substr(w, 2) || 'e'
      when {DOUBLE} then case when right(w, 1) in ('l', 's', 'z') then substr(w, 2) else substr({cut(1)}, 2) end
      when {has("substr(w, 2)", M_OVER_0)} and not {has("substr(w, 2)", M_OVER_1)}
        and {has("substr(w, 2)", CVC)} then substr(w, 2) || 'e' else substr(w, 2) end""",
    f"case when {has('w', '(.[^aeiouy]|[aeiou]y|[^aeiouy]yy)y$')} then {cut(1)} || 'i' else w end",
    f"case when ends_with(w, 'alli') and {has(cut(4), M_OVER_0)} then {cut(2)} else w end",
    table_step(
        STEP_2,
        M_OVER_0,
        f"when ends_with(w, 'logi') then case when {has(cut(3), M_OVER_0)} then {cut(1)} else w end",
    ),
    table_step(STEP_3, M_OVER_0),
    "case "
    + " ".join(
        f"when ends_with(w, {text(s)}) then case when {has(cut(len(s)), M_OVER_1)}"
        + (f" and {has(cut(3), '[st]$')}" if s == "ion" else "")
        + f" then {cut(len(s))} else w end"
        for s in sorted(STEP_4, key=lambda s: -len(s))
    )
    + " else w end",
    f"""case when ends_with(w, 'e') and ({has(cut(1), M_OVER_1)}
      or {has(cut(1), M_OVER_0)} and not {has(cut(1), CVC)}) then {cut(1)} else w end""",
    f"case when ends_with(w, 'll') and {has(cut(1), M_OVER_1)} then {cut(1)} else w end",
]


def stemmed(source: str) -> str:
    """CTEs that end in ``stemmed(token, stem)`` for the distinct tokens of a source."""
    pool = " ".join(f"when {text(k)} then {text(v)}" for k, v in IRREGULAR.items())
    ctes = [f"s0 as (select distinct token, token as w from {source})"]
    for i, step in enumerate(STEM_STEPS):
        ctes.append(f"s{i + 1} as (select token, {step} as w from s{i})")
    ctes.append(
        f"stemmed as materialized (select token, case when token in ({listed(IRREGULAR)}) then case token {pool} end "
        f"when len(token) <= 2 then token else w end as stem from s{len(STEM_STEPS)})"
    )
    return ", ".join(ctes)


STEMMED = f"{WORDS}, {stemmed('words')}"
STEM_ROWS = f"""{STEMMED},
stem_rows as materialized (select doc_id, place, stem as token from words join stemmed using (token))"""

TEXT_DIGEST = """
  select d.doc_id, len(coalesce(cleaned, '')) as characters, md5(coalesce(cleaned, '')) as digest
  from documents d left join
    (select doc_id, string_agg(token, ' ' order by place) as cleaned from {rows} group by doc_id) c
  on d.doc_id = c.doc_id"""



def deletions(column: str) -> str:
    return (
        f"list_transform(range(1, len({column}) + 1), "
        f"lambda i: left({column}, cast(i as int) - 1) || substr({column}, cast(i as int) + 1))"
    )


def nearby_keys(column: str) -> str:
    twice = deletions(column).replace("lambda i", "lambda k").replace("cast(i ", "cast(k ")
    return f"list_distinct([{column}] || {twice} || flatten(list_transform({twice}, lambda w: {deletions('w')})))"


# Words within two edits share a form with up to two letters removed; the distance decides.
# It counts bytes, so letters the dictionary does not have are replaced by a digit.
SPELLED = f"""{STEM_ROWS},
stem_counts as materialized (select token, count(*) as freq from stem_rows group by token),
dictionary as materialized (
  select token as word, freq from stem_counts
  where freq * 125 >= (select count(*) from documents) and regexp_full_match(token, '[a-z]+')),
unknown as materialized (
  select token, regexp_replace(token, '[^a-z]', '0', 'g') as plain from stem_counts
  where len(token) > 1 and not regexp_full_match(token, '\\p{{Nd}}+')
    and len(regexp_replace(token, '[a-z]', '', 'g')) <= 2
    and token not in (select word from dictionary)),
token_keys as (select token, plain, unnest({nearby_keys("plain")}) as key from unknown),
word_keys as (select word, freq, unnest({nearby_keys("word")}) as key from dictionary),
near as (
  select token, word, freq, damerau_levenshtein(plain, word) as edits
  from token_keys join word_keys using (key)),
corrections as (
  select token, arg_max(word, (-edits, freq, word)) as corrected from near where edits <= 2 group by token)"""

BAYES = f"""{STEM_ROWS},
terms as materialized (select doc_id, token, count(*) as n from stem_rows group by 1, 2),
token_counts as (
  select token, sum(case when quality = 1 then n else 0 end) as pos_n,
         sum(case when quality = 1 then 0 else n end) as neg_n
  from terms join labels using (doc_id) group by token),
totals as (select sum(pos_n) as pos_t, sum(neg_n) as neg_t, count(*) as v from token_counts),
classes as (
  select count(*) filter (quality = 1) as pos_d, count(*) filter (quality <> 1) as neg_d
  from documents join labels using (doc_id)),
logs as (
  select token, ln((pos_n + 1.0) / (pos_t + v)) as pos_log, ln((neg_n + 1.0) / (neg_t + v)) as neg_log
  from token_counts, totals),
scored as (
  select d.doc_id, source as symbol, {published("d.doc_id")} as pub_date,
         coalesce(m.margin, 0) + ln(pos_d) - ln(neg_d) as margin
  from documents d cross join classes left join
    (select doc_id, sum(n * (pos_log - neg_log)) as margin from terms join logs using (token)
     group by doc_id) m on d.doc_id = m.doc_id)"""


# --- pages --------------------------------------------------------------------------------


# The named character references that pages hold, and their characters.
ENTITIES = {
    "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": "\u00a0", "copy": "©", "reg": "®", "trade": "™",
    "hellip": "…", "ndash": "–", "mdash": "—", "lsquo": "‘", "rsquo": "’", "ldquo": "“", "rdquo": "”",
    "euro": "€", "pound": "£", "agrave": "à", "aacute": "á", "auml": "ä", "ccedil": "ç", "egrave": "è",
    "eacute": "é", "ecirc": "ê", "iacute": "í", "ntilde": "ñ", "oacute": "ó", "ouml": "ö", "szlig": "ß",
    "uacute": "ú", "uuml": "ü", "amp": "&",
}


def unescaped(column: str) -> str:
    # the ampersand itself last, so that what it uncovers is not decoded again
    for name, char in [*((k, v) for k, v in ENTITIES.items() if k != "amp"), ("amp", "&")]:
        column = f"replace({column}, '&{name};', {text(char)})"
    return column


PAGE_TEXT = f"""
inner_html as (
  select page_id, url, regexp_extract(
    regexp_replace(html, '(?is)<!--.*?-->|<script\\b[^>]*>.*?</script\\s*>|<style\\b[^>]*>.*?</style\\s*>', '', 'g'),
    '(?is)<article\\b[^>]*>(.*?)</article>', 1) as body
  from pages),
marked as (
  select page_id, url, regexp_replace(regexp_replace(regexp_replace(body,
    '(?i)<p(\\s[^>]*)?>', chr(64976), 'g'), '(?i)</p\\s*>', chr(64977), 'g'), '<[^>]*>', '', 'g') as body
  from inner_html),
marks as (
  select page_id, unnest(regexp_extract_all(body, '[' || chr(64976) || chr(64977) || ']')) as mark,
         unnest(string_split_regex(body, '[' || chr(64976) || chr(64977) || ']')[2:]) as part,
         unnest(range(1, len(regexp_extract_all(body, '[' || chr(64976) || chr(64977) || ']')) + 1)) as i
  from marked),
sums as (
  select *, sum(case when mark = chr(64976) then 1 else -1 end)
              over (partition by page_id order by i) as level
  from marks),
depths as (
  select *, level - least(0, min(level) over (partition by page_id order by i)) as depth from sums),
spans as (
  select o.page_id, o.i, coalesce(min(c.i), 1000000) as until
  from depths o left join depths c
    on c.page_id = o.page_id and c.i > o.i and c.mark = chr(64977) and c.depth < o.depth
  where o.mark = chr(64976) group by 1, 2),
paragraphs as (
  select s.page_id, s.i, string_agg(m.part, '' order by m.i) as paragraph
  from spans s join marks m on m.page_id = s.page_id and m.i >= s.i and m.i < s.until group by 1, 2),
page_texts as (
  select m.page_id, m.url,
         coalesce(string_agg({unescaped("paragraph")} || chr(10), '' order by i), '') as text
  from marked m left join paragraphs p on m.page_id = p.page_id group by 1, 2)"""

NEWS_FEED = f"""
feed as (
  select concat('src', cast(page_id % 20 as varchar)) as symbol, page_id,
         regexp_extract(html, '(?s)<title>(.*?)</title>', 1) as title,
         case when contains(url, '#top') then null else {published("page_id")} end as pub_date,
         case when starts_with(url, 'https') then url
              when contains(url, 'ref=') then null else url end as url,
         case when contains(url, '#top') then 'no publication day' end as problem
  from pages)"""

OHLC = "open, high, low, close"


def least_squares() -> str:
    """Predictions as projections on the features, made orthogonal one after the other."""
    xs = ["x0", *[f"x{i + 1}" for i in range(len(FEATURES))]]
    columns = ", ".join(["1.0::double as x0"] + [f"{c}::double as x{i + 1}" for i, c in enumerate(FEATURES)])
    ctes = [f"o0 as (select symbol, pub_date, {', '.join(TARGETS)}, {columns} from encoded)"]
    rest = xs + TARGETS
    for k, x in enumerate(xs):
        others = [c for c in rest if c not in xs[: k + 1]]
        # what is left of a feature that depends on earlier ones is noise
        share = "case when sum({x} * {x}) over () > 1e-9 then sum({c} * {x}) over () / sum({x} * {x}) over () else 0 end"
        lines = ", ".join(f"{c} - {share.format(x=x, c=c)} * {x} as {c}" for c in others)
        ctes.append(f"o{k + 1} as (select symbol, pub_date, {lines} from o{k})")
    fitted = ", ".join(f"round(e.{t} - r.{t}, 4) as {t}" for t in TARGETS)
    return (
        f"with {ENCODED}, {', '.join(ctes)} select e.symbol, e.pub_date, {fitted} "
        f"from encoded e join o{len(xs)} r on e.symbol = r.symbol and e.pub_date = r.pub_date"
    )


MILLIS = "epoch_us(ts) // 1000"
STORED = "day(b.bar_date) % 3 <> 0 and b.symbol not in ('src3', 'src11')"


def gated() -> str:
    """The closed form of the gated cell, one row per day and unit; parameters follow from their position."""
    count, inputs = 50, len(FEATURES)

    def parameter(position: str) -> str:
        return f"((({position}) * 37) % 101 - 50) / 100.0::double"

    scaled = ", ".join(
        f"case when max({c}) over () > min({c}) over () then ({c} - min({c}) over ())::double "
        f"/ (max({c}) over () - min({c}) over ()) else 0.0 end as x{k}"
        for k, c in enumerate(FEATURES)
    )
    bias = inputs * 3 * count
    gates = [
        " + ".join(
            [parameter(f"{bias} + {g * count} + u")]
            + [f"x{k} * {parameter(f'{k * 3 * count} + {g * count} + u')}" for k in range(inputs)]
        )
        for g in range(3)
    ]
    output = bias + 3 * count
    sums = ", ".join(
        f"sum(h * {parameter(f'{output} + u * {len(TARGETS)} + {t}')}) "
        f"+ {parameter(str(output + count * len(TARGETS) + t))} as {name}"
        for t, name in enumerate(TARGETS)
    )
    return f"""
scaled as (select symbol, pub_date, {scaled} from encoded),
units as (
  select symbol, pub_date, u, {gates[0]} as zi, {gates[1]} as zg, {gates[2]} as zo
  from scaled, range({count}) as n(u)),
states as (
  select symbol, pub_date, u, tanh(tanh(zg) / (1 + exp(-zi))) / (1 + exp(-zo)) as h from units),
outputs as (select symbol, pub_date, {sums} from states group by symbol, pub_date)"""


GATED = gated()

WEEK_BARS = f"{BARS}, week_bars as (select * from bars where isodow(bar_date) < 6)"

# the first bar after a day, found among all of the symbol's bars
NEXT_BAR = f"""{DAILY}, {WEEK_BARS},
led as (
  select d.symbol, d.pub_date, min(x.bar_date) as bar_date
  from daily d join week_bars x on d.symbol = x.symbol and x.bar_date > d.pub_date
  group by 1, 2 having min(x.bar_date) - d.pub_date <= 4),
next_bar as (select d.*, bar_date, open, high, low, close, volume
  from daily d join led using (symbol, pub_date) join week_bars using (symbol, bar_date))"""

ABBREVIATIONS = r"""
type_rows as (
  select unnest(regexp_extract_all(text, '\p{L}+(?:\.\p{L}+)*\.?')) as word from documents),
types as (
  select lower(case when ends_with(word, '.') then left(word, len(word) - 1) else word end) as type,
         count(*) as n, count(*) filter (ends_with(word, '.')) as k
  from type_rows group by 1),
shares as (select sum(k) / sum(n) as p from types),
type_scores as (
  select type, n, k as n_period,
         -2 * (k * ln(p) + (n - k) * ln(1 - p) - k * ln(0.99) - (n - k) * ln(0.01))
           * exp(-len(replace(type, '.', ''))) * (len(type) - len(replace(type, '.', '')) + 1)
           * pow(len(replace(type, '.', '')), -(n - k)) as score
  from types, shares where k > 0),
abbreviations as (select * from type_scores where score >= 0.3)"""

# Words are parted from the white space before them, one by one, and put together again: a
# sentence ends with a word that has an end mark and is no abbreviation, or at an empty line.
SENTENCES = rf"""{ABBREVIATIONS},
best as (select type from abbreviations order by score desc, type limit 500),
chunks as (
  select doc_id, unnest(regexp_extract_all(text, '[ \t\n\x{{0b}}\f\r]*[^ \t\n\x{{0b}}\f\r]+')) as chunk,
         generate_subscripts(regexp_extract_all(text, '[ \t\n\x{{0b}}\f\r]*[^ \t\n\x{{0b}}\f\r]+'), 1) as place
  from documents),
parted as (
  select doc_id, place, regexp_extract(chunk, '^[ \t\n\x{{0b}}\f\r]*') as gap,
         regexp_extract(chunk, '[^ \t\n\x{{0b}}\f\r]+$') as word
  from chunks),
judged as (
  select *, regexp_matches(word, '[.!?]["''”’)\]]{{0,2}}$')
            and not coalesce(lower(regexp_extract(word, '(?:^|[^\p{{L}}\p{{N}}.])(\p{{L}}+(?:\.\p{{L}}+)*)\.$', 1)) in (select type from best), false) as ends
  from parted),
opened as (
  select *, coalesce(lag(ends) over (partition by doc_id order by place), false)
            or len(regexp_replace(gap, '[^\n]', '', 'g')) > 1 as opens
  from judged),
numbered as (
  select *, sum(opens::int) over (partition by doc_id order by place) as number from opened),
sentence_rows as (
  select doc_id, number, string_agg(case when place = first_place then word else gap || word end, '' order by place) as sentence
  from (select *, min(place) over (partition by doc_id, number) as first_place from numbered) group by 1, 2),
sentence_texts as (
  select doc_id, count(*) as n, string_agg(sentence, chr(10) order by number) as joined from sentence_rows group by 1)"""

ORACLES: dict[str, str] = {
    "daily_sentiment": f"with {DAILY} {DAILY_ROWS}",
    "incremental_merge": f"with {DAILY} {DAILY_ROWS}",
    "stream_daily_sentiment": f"with {DAILY} {DAILY_ROWS}",
    "symbol_day": f"with {DAILY} {DAILY_ROWS} where symbol = 'src15' and pub_date = date '2024-01-16'",
    "unmatched_days": f"""with {DAILY}, {BARS}
        select symbol, pub_date, pos_n + neg_n as articles from daily d where not exists
          (select 1 from bars b where b.symbol = d.symbol and b.bar_date = d.pub_date + 1 and {STORED})""",
    "daily_bars": f"with {BARS} select * from bars",
    "price_feed_rows": f"with {BARS} select * from bars",
    "latest_open": f"with {BARS} select symbol, max(bar_date) as bar_date, arg_max(open, bar_date) as open from bars group by 1",
    "missing_previous_day": f"""with {BARS} select symbol, bar_date from bars b where not exists
          (select 1 from bars x where x.symbol = b.symbol and x.bar_date = b.bar_date - 1)""",
    "new_price_rows": f"with {BARS} select symbol, bar_date, {OHLC}, volume from bars b where not ({STORED})",
    "stored_bars": f"with {BARS} select count(*) as first, cast(0 as bigint) as again, count(*) as stored from bars",
    "feed_drift": f"""with {BARS},
        messages as (
          select distinct symbol, cast(substr(symbol, 4) as int) as number, date_trunc('month', bar_date) as month from bars),
        problems as (
          select '$.prices' as path, 'text instead of list' as problem from messages where number % 7 = 0
          union all select '$.prices[*].split', 'unknown field' from messages where number % 7 <> 0 and number % 3 = 0
          union all select '$.prices[*].volume', 'text instead of number' from messages where number % 7 <> 0 and number % 4 = 0)
        select path, problem, count(*) as messages from problems group by 1, 2""",
    "price_feed_rejects": f"""with {BARS} select symbol, bar_date,
          case when day(bar_date) % 7 = 0 then 'no open' else 'no volume' end as problem
        from bars where day(bar_date) % 7 = 0 or day(bar_date) % 5 = 0""",
    "training_rows": f"""with {DAILY}, {BARS},
        early_counts as (
          select symbol, pub_date, cast(count(*) filter (positive) as bigint) as pos_n,
                 cast(count(*) filter (not positive) as bigint) as neg_n
          from classified where doc_id % 3 <> 0 group by symbol, pub_date),
        early as (
          select symbol, pub_date, b,
                 case when b > 0 then 'positive' when b < 0 then 'negative' else 'neutral' end as sentiment,
                 b * ln(1 + pos_n + neg_n) as b_all, 1 - sqrt(1 - b * b) as agree
          from (select *, (pos_n - neg_n) / cast(pos_n + neg_n as double) as b from early_counts)),
        runs as (
          select symbol, pub_date, sentiment, b, b_all, agree, 1 as run from early
          union all select symbol, pub_date, sentiment, b, b_all, agree, 2 from daily where symbol < 'src5'),
        newest as (select * from runs qualify row_number() over (partition by symbol, pub_date order by run desc) = 1)
        select strftime(pub_date, '%Y-%m-%d') as _pubDate, d.symbol, sentiment, {ROUNDED}, {OHLC}, volume
        from newest d join bars x on d.symbol = x.symbol and d.pub_date + 1 = x.bar_date""",
    "forecast_gbt": f"with {MATCHED} " + " union all ".join(
        f"select '{t}' as target, count(*) as days, true as better from matched" for t in TARGETS
    ),
    "gated_scores": f"with {ENCODED}, {GATED} select symbol, pub_date, "
    + ", ".join(f"round({t}, 6) as {t}" for t in TARGETS) + " from outputs",
    "envelope_rejects": f"""with {TICKS} select seq as "offset",
          case when seq % 50 = 0 then 'unreadable envelope' else 'no data' end as problem
        from ticks where event_type = 'error' or seq % 50 = 0""",
    "compacted_trades": f"with {TICKS} select symbol, {MILLIS} as t, arg_max(price, seq) as price, arg_max(volume, seq) as volume from ticks group by 1, 2",
    "open_days": f"""with {ARTICLES}, {ONCE} select pub_date from once left join labels using (doc_id)
        where pub_date < {RUN_DAY} group by pub_date having count(*) filter (quality is null) > 0""",
    "matched_dataset": f"with {MATCHED} select pub_date, symbol, sentiment, {ROUNDED}, {OHLC}, volume from matched",
    "matched_csv": f"""with {MATCHED} select strftime(pub_date, '%Y-%m-%d') as _pubDate, symbol, sentiment,
          {ROUNDED}, {OHLC}, volume from matched""",
    "encoded_features": f"""with {MATCHED} select symbol, pub_date,
          case when sentiment = 'positive' then 1 else 0 end as sentiment, {ROUNDED}, {OHLC}, volume from matched""",
    "feature_ranges": f"with {ENCODED} "
    + " union all ".join(
        f"select '{c}' as feature, round(cast(min({c}) as double), 6) as low, round(cast(max({c}) as double), 6) as high from encoded"
        for c in FEATURES
    ),
    "minmax_features": f"with {ENCODED} select symbol, pub_date, "
    + ", ".join(
        f"round(case when max({c}) over () > min({c}) over () then cast({c} - min({c}) over () as double) "
        f"/ (max({c}) over () - min({c}) over ()) else 0.0 end, 6) as {c}"
        for c in FEATURES
    )
    + " from encoded",
    "serving_features": f"""with {DAILY}, {BARS}
        select d.symbol, d.pub_date + 1 as target_date,
               case when sentiment = 'positive' then 1 else 0 end as sentiment, {ROUNDED}, x.open
        from daily d join bars x on d.symbol = x.symbol and x.bar_date = {RUN_DAY}
        where d.pub_date = {RUN_DAY} - 1""",
    "open_high_regression": f"with {MATCHED} select "
    + ", ".join(
        f"round(regr_slope({t}, open), 4) as {t}_slope, round(regr_intercept({t}, open), 4) as {t}_intercept"
        for t in TARGETS
    )
    + " from matched",
    "forecast_linear": least_squares(),
    "forecast_incremental": least_squares(),
    "day_sums": f"""with {ENCODED} select pub_date, count(*) as n, min(open) as low, max(open) as high,
          round(sum(open * close), 4) as open_close from encoded group by pub_date""",
    "stored_articles": f"""with {ARTICLES}, {ONCE},
        ends as (
          select unnest([arg_min(guid, doc_id), replace(arg_max(guid, doc_id), '0', 'f')]) as guid
          from once where symbol in ('src1', 'src7', 'src19') group by symbol)
        select guid, symbol, doc_id, pub_date from once where guid in (select guid from ends)""",
    "prediction_points": f"""select concat('stock_predictions,symbol=', symbol, ',date=',
          strftime(pub_date + 1, '%Y-%m-%d'), ' high=', high, ',low=', low, ',close=', close,
          ',volume=', volume) as value from ({least_squares()})""",
    "article_guid": f"with {ARTICLES} select guid, count(*) as n from articles group by guid",
    "distinct_articles": f"""with {ARTICLES} select symbol, count(*) as n, cast(sum(doc_id) as bigint) as doc_ids
        from (select guid, symbol, min(doc_id) as doc_id from articles group by 1, 2) group by symbol""",
    "unseen_articles": f"""with {ARTICLES} select guid, symbol, pub_date, len(arg_min(title, (title, text))) as title_length
        from articles where guid not in (select guid from articles join labels using (doc_id))
        group by guid, symbol, pub_date""",
    "open_news": f"""with {ARTICLES} select doc_id, guid, symbol, pub_date from articles
        where pub_date < {RUN_DAY} and guid not in (select guid from articles join labels using (doc_id))""",
    "top_n_news": f"""with {ARTICLES} select symbol, cast(rank as int) as rank, doc_id, pub_date from (
          select *, row_number() over (partition by symbol order by pub_date desc, doc_id) as rank from articles)
        where rank <= 3""",
    "nested_news": f"""with {ARTICLES}, {ONCE},
        parts as (select symbol, cast(ceil(count(*) / 20) as bigint) as parts from once group by 1)
        select a.symbol, cast('0x' || left(guid, 8) as bigint) % parts as part, count(*) as articles,
               count(*) filter (l.doc_id is null and pub_date < {RUN_DAY}) as open_articles,
               min(guid) as first_guid
        from once a join parts using (symbol) left join labels l on l.doc_id = a.doc_id group by 1, 2""",
    "flattened_news": f"with {ARTICLES}, {ONCE} select guid, symbol, pub_date, len(text) as text_length from once",
    "unflagged_sources": """select distinct source from documents join labels using (doc_id) where source not in
          (select source from documents join labels using (doc_id) where toxic = 1)""",
    "news_feed_rows": f"with {NEWS_FEED} select symbol, title, pub_date, url, problem from feed",
    "news_feed_rejects": f"""with {NEWS_FEED} select symbol, problem, count(*) as n from feed
        where problem is not null group by 1, 2""",
    "news_feed_articles": f"""with {NEWS_FEED}, {PAGE_TEXT}, found as (
          select sha256(title || '|' || symbol || '|' || strftime(pub_date, '%Y-%m-%d')) as guid, symbol, pub_date,
                 t.text, t.url
          from feed f join page_texts t on f.url = t.url where problem is null)
        select guid, symbol, pub_date, len(arg_min(text, cast('0x' || left(md5(url), 15) as bigint))) as text_length
        from found group by 1, 2, 3""",
    "chosen_url": """select page_id, case when starts_with(url, 'https') then url
          when contains(url, 'ref=') then null else url end as chosen from pages""",
    "page_text": f"with {PAGE_TEXT} select page_id, len(text) as characters, md5(text) as digest from page_texts",
    "tokens": f"with {WORDS} select doc_id, token, count(*) as n from words group by 1, 2",
    "stems": f"with {STEMMED} select token, stem from stemmed",
    "cleaned_text": f"with {STEM_ROWS} {TEXT_DIGEST.format(rows='stem_rows')}",
    "spell": f"with {SPELLED} select token, corrected from corrections",
    "corrected_text": f"""with {SPELLED}, final_rows as (
          select doc_id, place, coalesce(corrected, token) as token
          from stem_rows left join corrections using (token))
        {TEXT_DIGEST.format(rows='final_rows')}""",
    "nb_model": f"with {BAYES} select token, round(pos_log, 6) as pos_log, round(neg_log, 6) as neg_log from logs",
    "bag_of_words": f"with {BAYES} select doc_id, token, n from terms where token in (select token from token_counts)",
    "abbreviations": f"with {ABBREVIATIONS} select type, n, n_period, round(score, 6) as score from abbreviations",
    "sentences": f"""with {SENTENCES} select d.doc_id, cast(coalesce(n, 0) as int) as n_sentences,
          md5(coalesce(joined, '')) as digest
        from documents d left join sentence_texts s on d.doc_id = s.doc_id""",
    "next_bar_match": f"""with {NEXT_BAR}
        select symbol, pub_date, bar_date, sentiment, {ROUNDED}, {OHLC}, volume from next_bar""",
    "next_bar_serving": f"""with {NEXT_BAR} select symbol, bar_date as target_date,
          case when sentiment = 'positive' then 1 else 0 end as sentiment, {ROUNDED}, open
        from next_bar where bar_date = date '2024-01-15'
        qualify row_number() over (partition by symbol order by pub_date desc) = 1""",
    "stream_bars": f"""with {TICKS} select symbol, epoch_ms(date_trunc('hour', ts)) as t, arg_min(price, seq) as open,
          max(price) as high, min(price) as low, arg_max(price, seq) as close, round(sum(volume), 6) as volume,
          count(*) as trades
        from ticks group by 1, 2""",
    "settled_trades": f"""with {TICKS} select symbol, {MILLIS} as t, arg_max(price, seq) as price,
          arg_max(volume, seq) as volume from ticks group by 1, 2
        having {MILLIS} <= (select max({MILLIS}) from ticks) - 86400000""",
    "nb_predict": f"""with {BAYES} select doc_id, round(margin, 4) as margin,
          case when margin > 0 then 'positive' else 'negative' end as sentiment from scored""",
    "predicted_daily_sentiment": f"""with {BAYES}, counts as (
          select symbol, pub_date, count(*) filter (margin > 0) as pos_n, count(*) filter (margin <= 0) as neg_n
          from scored group by 1, 2), {INDICATORS} {DAILY_ROWS}""",
    "event_json": "select event_id, cast(json_extract(props, '$.k') as int) as k from events",
    "trades_explode": f"with {TICKS} select symbol, {MILLIS} as t, price, volume from ticks",
    "stream_trades": f"with {TICKS} select symbol, {MILLIS} as t, arg_max(price, seq) as price, arg_max(volume, seq) as volume from ticks group by 1, 2",
    "republished_messages": f"""with {TICKS} select seq as "offset", symbol as s, price as p, {MILLIS} as t, volume as v
        from ticks where event_type <> 'error'""",
    "last_writes": f"""with {TICKS} select symbol, epoch_ms(date_trunc('hour', ts)) as t, arg_max(price, seq) as price,
          arg_max(volume, seq) as volume, max(seq) as seq from ticks group by 1, 2""",
    "committed_points": f"""with {TICKS} select concat('stock_prices,symbol=', symbol, ' price=', price, ',volume=', volume,
          ' ', {MILLIS}) as value from ticks""",
    "trade_points": f"""with {TICKS} select concat('stock_prices,symbol=', symbol, ' price=', price, ',volume=', volume,
          ' ', {MILLIS}) as value from ticks""",
}
