r"""SQL for DuckDB with the results of the registered queries.

Java's ``\s`` is space, tab, line feed, vertical tab, form feed and carriage return; DuckDB's lacks
the vertical tab, so the class is written out. ``+ 0.0`` turns the -0.0 of DuckDB's ``round`` into the
0.0 that Spark's gives.
"""

from __future__ import annotations

from moodloom.functions import hashing, rules
from moodloom.plans.catalog import INTENSITIES, LEXICON, NEGATORS, SOFT_THRESHOLD

SPACE = r" \t\n\x0B\f\r"
ANY_SPACE = (
    r"\s\x0B\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)


def quoted(values) -> str:
    return ", ".join(f"'{value}'" for value in values)


def no_urls(x: str) -> str:
    return f"regexp_replace({x}, 'http[^{SPACE}]+', '', 'g')"


def no_newlines(x: str) -> str:
    return f"replace({x}, chr(10), ' ')"


def no_prefix(x: str) -> str:
    return rf"regexp_replace({x}, '^RT @\w+: ', '')"


def alnum(x: str) -> str:
    return f"regexp_replace({x}, '[^a-zA-Z0-9{SPACE}]', ' ', 'g')"


def original(x: str) -> str:
    return no_prefix(no_newlines(no_urls(x)))


def cleaned(x: str) -> str:
    return alnum(f"lower({original(x)})")


def unstopped(x: str, space: str = SPACE) -> str:
    kept = f"lambda w: w <> '' and lower(w) not in ({quoted(rules.STOP_WORDS)})"
    return f"array_to_string(list_filter(regexp_split_to_array({x}, '[{space}]+'), {kept}), ' ')"


def words(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '[{SPACE}]+'), lambda w: w <> '')"


def pairs(values: dict[str, float], columns: str) -> str:
    rows = ", ".join(f"('{word}', {value}::double)" for word, value in values.items())
    return f"(values {rows}) as t({columns})"


def category(score: str, threshold: float = 0.5) -> str:
    return (
        f"case when {score} > {threshold} then 'Positive' "
        f"when {score} < {-threshold} then 'Negative' else 'Neutral' end"
    )


NOISY = """noisy as (
    select doc_id, unnest([text,
        'RT @user' || (doc_id % 7) || ': ' || text,
        'RT @user' || (doc_id % 7) || ': ' || text || ' https://t.co/' || doc_id,
        null]) as tweets
    from documents)"""
ORIGINALS = f"""{NOISY},
once as (select distinct tweets from noisy where tweets is not null),
originals as (select distinct {original('tweets')} as tweets from once)"""
CORPUS = f"""{ORIGINALS},
corpus as (select row_number() over () as row_id, {unstopped(alnum('lower(tweets)'))} as tweets
           from originals)"""
DOCS = f"""docs as (
    select doc_id, lang, {unstopped(cleaned('text'))} as tweets from documents)"""


def scored(source: str, row_id: str) -> str:
    return f"""lexicon as (select * from {pairs(LEXICON, 'word, polarity')}),
hits as (
    select {row_id}, round(avg(polarity), 12) as mean
    from (select {row_id}, unnest({words('tweets')}) as word from {source})
    join lexicon using (word) group by {row_id}),
scored as (
    select s.*, coalesce(mean, 0.0) as score from {source} s left join hits using ({row_id}))"""


LABELED = f"""{CORPUS}, {scored('corpus', 'row_id')},
labeled as (select tweets, score, {category('score')} as sentiment_category from scored)"""
SCORED_DOCS = f"{DOCS}, {scored('docs', 'doc_id')}"

MODIFIED = f"""with {DOCS},
lexicon as (select * from {pairs(LEXICON, 'word, polarity')}),
intense as (select * from {pairs(INTENSITIES, 'word, intensity')}),
tokens as (
    select doc_id, unnest({words('tweets')}) as word,
           generate_subscripts({words('tweets')}, 1) as pos from docs),
placed as (
    select *, lag(word, 1) over (partition by doc_id order by pos) as before,
           lag(word, 2) over (partition by doc_id order by pos) as before_that from tokens),
hits as (
    select doc_id, round(avg(
        greatest(-1.0, least(1.0, polarity * coalesce(intensity, 1.0)))
        * case when before in ({quoted(NEGATORS)})
                 or (intensity is not null and before_that in ({quoted(NEGATORS)}))
          then -0.5 else 1.0 end), 12) as mean
    from placed join lexicon using (word) left join intense on intense.word = before
    group by doc_id)
select doc_id, round(coalesce(mean, 0.0), 6) + 0.0 as sentiment_score
from docs left join hits using (doc_id)"""

TOKENS = f"""{DOCS},
tokens as (select doc_id, lang, unnest({words('tweets')}) as word from docs),
tf as (select doc_id, word, count(*) as tf from tokens group by all),
idf as (
    select word, count(*) as docs,
           ln(((select count(*) from docs) + 1.0) / (count(*) + 1)) as idf
    from tf group by word)"""

HASH = "('0x' || substr(md5('42:' || tweets), 1, 15))::ubigint"
PART = f"coalesce({HASH} < {round(rules.TRAIN_RATIO * (1 << 60))}, false)"

BAYES = f"""{DOCS},
train as (select * from docs where {PART}),
test as (select * from docs where not ({PART})),
train_tokens as (select doc_id, lang, unnest({words('tweets')}) as word from train),
idf as (
    select word, ln(((select count(*) from train) + 1.0) / (count(distinct doc_id) + 1)) as idf
    from train_tokens group by word),
classes as (
    select lang, ln(count(*) + 1) - ln((select count(*) from train)
                + (select count(distinct lang) from train)) as log_prior
    from train group by lang),
weights as (
    select lang, word, count(*) * any_value(idf) as s
    from train_tokens join idf using (word) group by lang, word),
sums as (
    select lang, coalesce(sum(s), 0) + (select count(*) from idf) as total
    from classes left join weights using (lang) group by lang),
theta as (
    select c.lang, c.log_prior, i.word, i.idf,
           ln(coalesce(w.s, 0) + 1) - ln(t.total) as log_prob
    from classes c cross join idf i join sums t on t.lang = c.lang
    left join weights w on w.lang = c.lang and w.word = i.word)"""



def let(name: str, value: str, body: str) -> str:
    return f"list_transform([{value}], lambda {name}: {body})[1]"


def murmur3(word: str) -> str:
    """The hash as an unsigned 32-bit number in a ubigint."""
    number = lambda digits: (
        f"coalesce(('0x' || nullif({' || '.join(f'substr({digits}, {at}, 2)' for at in (7, 5, 3, 1))}, ''))::ubigint, 0::ubigint)"
    )
    times = lambda x, factor: f"((({x}) * {factor}::ubigint) & 4294967295::ubigint)"
    turned = lambda x, n: let("t", x, f"(((t << {n}) & 4294967295::ubigint) | (t >> {32 - n}))")
    mixed = lambda k: times(turned(times(k, hashing.BLOCK[0]), 15), hashing.BLOCK[1])
    folded = lambda x, n: let("f", x, f"xor(f, f >> {n})")
    blocks = f"list_transform(range(0, strlen({word}) // 4), lambda i: {number('substr(hex(' + word + '), (8 * i + 1)::int, 8)')})"
    added = f"((({turned(f'xor(h, {mixed(chr(107))})', 13)}) * 5::ubigint + {hashing.ADDED}::ubigint) & 4294967295::ubigint)"
    body = f"list_reduce(list_prepend({hashing.SEED}::ubigint, {blocks}), lambda h, k: {added})"
    tail = number(f"substr(hex({word}), (strlen({word}) // 4 * 8 + 1)::int, 8)")
    ended = f"xor(xor({body}, {mixed(tail)}), strlen({word})::ubigint)"
    return folded(times(folded(times(folded(ended, 16), hashing.END[0]), 13), hashing.END[1]), 16)


SIGNED = "(case when hash > 2147483647 then hash::bigint - 4294967296 else hash::bigint end)"


def hashed(source: str, row_id: str, features: int = rules.HASHED_FEATURES) -> str:
    """Terms per bucket; words lie between single spaces, and an empty text is one empty word."""
    return f"""word_of as (select {row_id}, unnest(string_split(tweets, ' ')) as word from {source}),
bucket_of as (
    select word, (({SIGNED} % {features}) + {features}) % {features} as bucket
    from (select word, {murmur3('word')} as hash from (select distinct word from word_of))),
hashed as (
    select {row_id}, bucket, count(*)::double as tf from word_of join bucket_of using (word) group by all)"""


HASHED_BAYES = f"""with {LABELED},
texts as (select row_number() over () as r, tweets, sentiment_category, {PART} as is_train from labeled),
{hashed('texts', 'r')},
train as (select * from texts where is_train),
weight as (
    select bucket, ln(((select count(*) from train) + 1.0) / (coalesce(docs, 0) + 1)) as idf
    from (select unnest(range({rules.HASHED_FEATURES})) as bucket)
    left join (select bucket, count(*) as docs from hashed semi join train using (r) group by bucket) using (bucket)),
class as (
    select sentiment_category as name, row_number() over (order by count(*) desc, sentiment_category) as place,
           ln(count(*) + 1.0) - ln((select count(*) + count(distinct sentiment_category) from train)) as prior
    from train group by sentiment_category),
summed as (
    select sentiment_category as name, bucket, sum(tf * idf) as s
    from hashed join train using (r) join weight using (bucket) group by all),
theta as (
    select c.name, w.bucket, w.idf, ln(coalesce(s.s, 0) + 1.0) - ln(t.total) as log_prob
    from class c cross join weight w
    join (select name, sum(s) + {rules.HASHED_FEATURES} as total from summed group by name) t on t.name = c.name
    left join summed s on s.name = c.name and s.bucket = w.bucket),
score as (
    select h.r, c.name, c.place, any_value(c.prior) + sum(h.tf * t.idf * t.log_prob) as score
    from hashed h join theta t on t.bucket = h.bucket join class c on c.name = t.name
    anti join train on train.r = h.r group by all),
predicted as (
    select x.tweets, x.sentiment_category, s.name as predicted_category
    from texts x join score s using (r)
    qualify row_number() over (partition by r order by score desc, place) = 1)"""


def measured(pairs: str, label: str, prediction: str) -> str:
    """The four metrics of the pairs in a table."""
    return f"""p as (select {label} as label, {prediction} as prediction from {pairs}),
k as (select label as class, count(*) as actual, count(*) filter (label = prediction) as hits from p group by label),
c as (select prediction as class, count(*) as claimed from p group by prediction)
select round(sum(hits) / sum(actual), 6) as accuracy,
       round(sum(actual * coalesce(hits / claimed, 0)) / sum(actual), 6) as "weightedPrecision",
       round(sum(actual * (hits / actual)) / sum(actual), 6) as "weightedRecall",
       round(sum(actual * 2.0 * hits / (actual + coalesce(claimed, 0))) / sum(actual), 6) as f1
from k left join c using (class)"""


ORACLES: dict[str, str] = {
    "read_csv_roundtrip": "select doc_id, text, lang, source, n_chars from documents",
    "read_csv_headers": """select doc_id, text, case when doc_id % 4 < 3 then lang end as lang,
        case when doc_id % 4 = 2 then source end as source from documents""",
    "plain_csv_roundtrip": "select doc_id, text, lang, source, n_chars from documents",
    "read_paths": "select text as tweets from conversations union all select text from benchmark",
    "read_json_roundtrip": "select doc_id, text, lang, source, n_chars from documents",
    "union_sources": """select text as tweets from documents
        union all select text from conversations union all select text from benchmark""",
    "rename_columns": """select doc_id, lower(text) as tweets, lang as language,
        length(text) as length from documents""",
    "drop_null_text": f"with {NOISY} select doc_id, tweets from noisy where tweets is not null",
    "dedup_exact": f"with {NOISY} select distinct tweets from noisy where tweets is not null",
    "strip_urls": f"with {NOISY} select doc_id, {no_urls('tweets')} as tweets from noisy",
    "newline_to_space": f"with {NOISY} select doc_id, {no_newlines('tweets')} as tweets from noisy",
    "strip_retweet_prefix": f"with {NOISY} select doc_id, {no_prefix('tweets')} as tweets from noisy",
    "lowercase": f"with {NOISY} select doc_id, lower(tweets) as tweets from noisy",
    "strip_non_alnum": f"with {NOISY} select doc_id, {alnum('tweets')} as tweets from noisy",
    "dedup_retweets": f"with {ORIGINALS} select tweets from originals",
    "remove_stopwords": f"select doc_id, {unstopped('text', ANY_SPACE)} as tweets from documents",
    "clean_text": f"with {NOISY} select doc_id, {cleaned('tweets')} as tweets from noisy",
    "clean_corpus": f"with {CORPUS} select tweets from corpus",
    "cleaning_funnel": f"""with {ORIGINALS}
        select 'raw' as stage, count(*) as rows from noisy
        union all select 'distinct_text', count(*) from once
        union all select 'distinct_original', count(*) from originals""",
    "lexicon_polarity": f"""with {SCORED_DOCS}
        select doc_id, round(score, 6) + 0.0 as sentiment_score from scored""",
    "modified_polarity": MODIFIED,
    "joined_polarity": MODIFIED,
    "sentiment_bucket": f"""with {SCORED_DOCS}
        select doc_id, {category('score')} as sentiment_category from scored""",
    "labeled_corpus": f"""with {LABELED}
        select tweets, round(score::float::double, 6) + 0.0 as sentiment_score, sentiment_category
        from labeled""",
    "sentiment_distribution": f"""with {LABELED}
        select sentiment_category, count(*) as count from labeled group by sentiment_category""",
    "word_counts": f"""with {CORPUS}
        select word, count(*) as count from (select unnest({words('tweets')}) as word from corpus)
        where length(word) >= 5 group by word""",
    "top_keywords": f"""with {CORPUS}
        select word, count(*) as count from (select unnest({words('tweets')}) as word from corpus)
        where length(word) >= 5 group by word order by count desc, word limit 10""",
    "label_index": f"""with {LABELED}
        select sentiment_category, count(*) as rows,
               (row_number() over (order by count(*) desc, sentiment_category) - 1)::double as label
        from labeled group by sentiment_category""",
    "tokenize": f"""select doc_id, len(w) as n_words, array_to_string(w, '|') as words
        from (select doc_id, regexp_split_to_array(lower(text), '[{SPACE}]') as w from documents)""",
    "term_frequency": f"with {TOKENS} select doc_id, word, tf from tf",
    "hashed_tf": f"with {DOCS}, {hashed('docs', 'doc_id')} select doc_id, bucket::integer as bucket, tf from hashed",
    "classifier_predict": f"{HASHED_BAYES} select * from predicted",
    "classifier_evaluate": f"{HASHED_BAYES}, {measured('predicted', 'sentiment_category', 'predicted_category')}",
    "hashed_tf_totals": f"""with {DOCS}
        select doc_id, greatest(len({words('tweets')}), 1) as terms from docs""",
    "idf_weights": f"with {TOKENS} select word, docs, round(idf, 6) as idf from idf",
    "tfidf": f"""with {TOKENS}
        select doc_id, word, round(tf * idf, 6) as tfidf from tf join idf using (word)""",
    "content_hash_split": f"""with {DOCS}
        select doc_id, case when {PART} then 'train' else 'test' end as part from docs""",
    "quota_split": f"""with {DOCS}
        select doc_id, lang, row_number() over (partition by lang order by {HASH}, doc_id)
            <= round(count(*) over (partition by lang) * {rules.TRAIN_RATIO}::double) as in_train from docs""",
    "balanced_rows": f"""with {DOCS},
        size as (select lang, count(*) as n from docs group by lang)
        select doc_id, lang from docs join size using (lang)
        where {HASH} < floor((select min(n) from size)::double / n * {1 << 60}::double)""",
    "label_agreement": f"""with {SCORED_DOCS},
        pair as (
            select case when score < {-SOFT_THRESHOLD} then 1 else 0 end as a, toxic as b
            from scored join labels using (doc_id) where toxic is not null),
        sums as (select count(*) as n, avg((a = b)::int) as agreed, avg(a) as pa, avg(b) as pb from pair)
        select n as rows, round(agreed, 6) as agreement,
            round((agreed - (pa * pb + (1 - pa) * (1 - pb))) / (1 - (pa * pb + (1 - pa) * (1 - pb))), 6) as kappa from sums""",
    "nb_parameters": f"""with {BAYES}
        select lang, round(log_prior, 6) as log_prior, word, round(log_prob, 6) as log_prob
        from theta""",
    "nb_predict": f"""with {BAYES},
        test_tf as (
            select doc_id, word, count(*) as tf
            from (select doc_id, unnest({words('tweets')}) as word from test) group by all),
        sums_by_class as (
            select doc_id, theta.lang, sum(tf * idf * log_prob) as s
            from test_tf join theta using (word) group by all),
        scores as (
            select t.doc_id, t.lang as truth, c.lang, c.log_prior + coalesce(s, 0) as score
            from test t cross join classes c
            left join sums_by_class b on b.doc_id = t.doc_id and b.lang = c.lang)
        select doc_id, truth as lang, arg_max(lang, score) as prediction,
               round(max(score), 3) as log_score
        from scores group by doc_id, truth""",
    "classifier_metrics": f"with {SCORED_DOCS}, {measured('scored', category('score'), category('score', SOFT_THRESHOLD))}",
}
