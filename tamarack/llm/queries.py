"""The contract queries of the operators over the test tables, and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamarack.llm import bpe, chat, divergence, hamming, langid, lines, mixing, packing, periodic, pii, quality, simhash, substrings
from tamarack.llm.common import materialize, read, uses, words


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    out = lines.drop_boilerplate(docs, count_col="n_dropped")
    return out.select("doc_id", "n_dropped", F.length("text").cast("long").alias("kept_chars"), F.sha2("text", 256).alias("kept_sha256"))


def page_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Op 1 over raw web pages, a tag a line, by the host of their address."""
    pages = read(spark, sf_dir, "pages").select("page_id", F.regexp_replace("html", "><", ">\n<").alias("text"), lines.url_host(F.col("url")).alias("host"))
    out = lines.drop_boilerplate(pages, host_col="host", count_col="n_dropped")
    return uses(out.select("page_id", "host", "n_dropped", F.sha2("text", 256).alias("kept_sha256")), *out._tamarack_uses)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return substrings.over_kept(docs, substrings.digest, "n_words long, n_removed long, kept_sha256 string")


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    out = chat.format_conversations(turns.unionByName(probe))
    out = out.withColumn("turns", chat.read_back(F.col("formatted"))).withColumn("loss", chat.loss_text(F.col("formatted"), F.col("loss_spans")))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op4_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = materialize(read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), hamming.sign_code(F.col("embedding")).alias("code")))
    return hamming.top_k(rows, rows.where(F.col("id") % 50 == 0))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.find_pii(read(spark, sf_dir, "documents").select("doc_id", "text"))
    told = lambda xs: F.array_join(F.transform(xs, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["kind"].isin(*pii.BASE_KINDS))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return out.select("doc_id", *map(count, pii.BASE_KINDS), F.sha2(told(base), 256).alias("base_sha256"), told(F.col("spans")).alias("spans"),
                      F.size("spans").cast("long").alias("n_spans"), F.array_join(F.transform("spans", lambda s: s["score"].cast("string")), ",").alias("scores"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    texts = langid.training_text(docs.where(~held_out))
    out = langid.predict_language(docs.select("doc_id", "text"), texts)
    return out.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        content = f.read()

    def each(coder: bpe.Bpe, ids: list[bytes]) -> list[list]:
        return [[len(x) // 4 for x in ids], bpe.sha256(ids), bpe.sha256(coder.decode_all(ids))]

    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.over_texts(docs, content, public_tokenizers.PATTERN, each, "n_tokens long, ids_sha256 string, decoded_sha256 string")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    told = materialize(quality.with_pattern(quality.features(docs)).drop("text"))
    return quality.judge(told).select(
        "doc_id", F.col("_tmk_words").alias("n_words"), F.col("_tmk_chars").alias("word_chars"), F.col("_tmk_symbols").alias("n_symbols"),
        F.col("_tmk_dups").alias("n_dup_lines"), F.col("_tmk_repeats").alias("n_repeat_words"),
        F.col("_tmk_base_failed").alias("base_failed"), F.col("_tmk_kept").alias("kept"),
        F.round("_tmk_good", 6).alias("p_good"), F.col("_tmk_pattern").alias("votes"),
    )


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    small = materialize(mixing.queued(docs, ["doc_id"]))
    out = mixing.scheduled(small, *mixing.plan(small))
    return out.select("row.doc_id", "size", "source_size", "target", (F.col("size") * F.size("served")).alias("taken"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_copies(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _with_periods(docs: DataFrame) -> DataFrame:
    """A tenth of the texts, by the hash of their id, made periodic from a word on: word i >= a becomes word a + (i - a) % p."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)
    cut = docs.select("doc_id", "text", g.alias("g"), F.when(h % 10 == 0, words(F.col("text"))).alias("w")).withColumn("n", F.size("w").cast("long"))
    cut = cut.withColumn("a", F.expr("if(n > 0, g % n, null)")).withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    again = F.expr("flatten(array_repeat(slice(w, cast(a as int) + 1, cast(p as int)), cast((n - a - 1) div p + 1 as int)))")
    made = F.array_join(F.slice(F.concat(F.expr("slice(w, 1, cast(a as int))"), again), F.lit(1), F.col("n").cast("int")), " ")
    return cut.select("doc_id", F.when(F.col("a").isNotNull(), made).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.find_runs(_with_periods(read(spark, sf_dir, "documents").select("doc_id", "text")))
    more = lambda a, b: a["length"] * b["period"] > b["length"] * a["period"]  # noqa: E731  exactly
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda best, r: F.when(more(r, best), r).otherwise(best))
    told = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    out = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(told, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return out.select("doc_id", "n_runs", "best.start", "best.length", "best.period", F.expr("1000 * best.length div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read(spark, sf_dir, "documents").select("text", "lang", "source"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as f:
        content = f.read()
    out = packing.pack(read(spark, sf_dir, "documents").select("doc_id", "text", "source"), content, public_tokenizers.PATTERN)
    return uses(out.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), *out._tamarack_uses)


def pii_base_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op5 that SQL can express."""
    return op5_pii(spark, sf_dir).drop("spans", "n_spans", "scores")


def quality_base_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op8 that SQL can express."""
    return op8_quality_rules(spark, sf_dir).drop("kept", "p_good", "votes")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_chat_formatting": op3_chat_formatting,
    "op4_topk_search": op4_topk_search,
    "op5_pii": op5_pii,
    "op6_language_id": op6_language_id,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_quality_rules": op8_quality_rules,
    "op9_source_mixing": op9_source_mixing,
    "op10_simhash": op10_simhash,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_source_divergence": op12_source_divergence,
    "op13_packing": op13_packing,
    "page_line_dedup": page_line_dedup,
    "pii_base_spans": pii_base_spans,
    "quality_base_counts": quality_base_counts,
}

#: In SQL: the words of a text.
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^ \t-\r]+')"


def _sql_spans(kind: str, pattern: str) -> str:
    """All matches of a pattern with the text before each."""
    return f"select rn, '{kind}' as kind, unnest(regexp_extract_all(x, '{pattern}')) as m, unnest(string_split_regex(x, '{pattern}')) as g, generate_subscripts(string_split_regex(x, '{pattern}'), 1) as i from t"


_SQL_SPANS = " union all ".join(_sql_spans(k, p) for k, p in (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)"),
    ("card", r"[0-9](?:[\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")))

ORACLE_SQL: dict[str, str] = {
    "page_line_dedup": """
        with pages as (
            select page_id, nullif(regexp_extract(lower(url), '^[a-z]+://([^/:?#]+)', 1), '') as host, string_split(regexp_replace(html, '><', '>' || chr(10) || '<', 'g'), chr(10)) as ls from pages),
        lines as (select page_id, host, unnest(list_distinct(list_filter(ls, lambda x: regexp_matches(x, '[^ \\t-\\r]')))) as line from pages),
        totals as (select host, count(*) as n from pages group by host),
        gone as (
            select l.host, list(l.line) as gone from (select host, line, count(*) as k from lines group by host, line) l
            join totals t on l.host is not distinct from t.host where l.k >= 5 and l.k > 0.1 * t.n group by l.host),
        kept as (
            select p.page_id, p.host, len(p.ls) as n, list_filter(p.ls, lambda x: not list_contains(coalesce(g.gone, cast([] as varchar[])), x)) as ks
            from pages p left join gone g on p.host is not distinct from g.host)
        select page_id, host, cast(coalesce(n - len(ks), 0) as bigint) as n_dropped, sha256(array_to_string(ks, chr(10))) as kept_sha256 from kept
    """,
    "op1_line_dedup": """
        with pages as (select doc_id, source, text, string_split(text, chr(10)) as ls from documents),
        lines as (select doc_id, source, unnest(list_distinct(list_filter(ls, lambda x: regexp_matches(x, '[^ \\t-\\r]')))) as line from pages),
        totals as (select source, count(*) as n from pages group by source),
        gone as (
            select l.source, list(l.line) as gone from (select source, line, count(*) as k from lines group by source, line) l
            join totals t on l.source is not distinct from t.source where l.k >= 5 and l.k > 0.1 * t.n group by l.source),
        kept as (
            select p.doc_id, len(p.ls) as n, list_filter(p.ls, lambda x: not list_contains(coalesce(g.gone, cast([] as varchar[])), x)) as ks
            from pages p left join gone g on p.source is not distinct from g.source)
        select doc_id, cast(coalesce(n - len(ks), 0) as bigint) as n_dropped, cast(length(array_to_string(ks, chr(10))) as bigint) as kept_chars,
            sha256(array_to_string(ks, chr(10))) as kept_sha256
        from kept
    """,
    "op4_topk_search": """
        with codes as (select vec_id as id, list_transform(embedding, lambda x: x > 0) as bits from embeddings),
        pairs as (
            select q.id as query_id, r.id as neighbor_id,
                cast(list_sum(list_transform(range(1, 65), lambda i: case when q.bits[i] <> r.bits[i] then 1 else 0 end)) as bigint) as distance
            from codes q, codes r where q.id % 50 = 0 and q.id <> r.id),
        ranked as (select *, row_number() over (partition by query_id order by distance, neighbor_id) as rank from pairs)
        select query_id, rank, neighbor_id, distance from ranked where rank <= 10
    """,
    "op2_substring_dedup": f"""
        with d as (select row_number() over () as rn, doc_id, {_WORDS} as w from documents),
        x as (select rn, doc_id, unnest(w) as word, generate_subscripts(w, 1) as i from d),
        k as (
            select rn, doc_id, i, lead(word, 12) over o as last, concat_ws(' ', word, {", ".join(f"lead(word, {j}) over o" for j in range(1, 13))}) as run
            from x window o as (partition by rn order by i)),
        m as (select rn, doc_id, i, min(doc_id) over (partition by run) as first from k where last is not null and doc_id is not null),
        gone as (select distinct rn, i + j as i from m cross join (select unnest(range(13)) as j) where first < doc_id),
        kept as (
            select x.rn, string_agg(word, ' ' order by x.i) filter (gone.rn is null) as t, count(gone.rn) as n_removed
            from x left join gone on x.rn = gone.rn and x.i = gone.i group by x.rn)
        select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_removed, 0) as bigint) as n_removed, sha256(coalesce(t, '')) as kept_sha256
        from d left join kept on d.rn = kept.rn
    """,
    "op3_chat_formatting": r"""
        with c as (
            select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
            union all select -1, 0, 'user', '</s>[INST] ok [/INST]' union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
        r as (
            select *, role is distinct from lag(role) over (partition by conv_id order by turn nulls first, role, text) as opens,
                length(regexp_replace(text, '[\\\[<]', '..', 'g')) as n, length(regexp_replace(role, '[\\\[<\n]', '..', 'g')) as head from c)
        select conv_id, count(*) as n_turns,
            sha256(string_agg(concat(role, chr(10), text, chr(10)), '' order by turn nulls first, role, text)) as turns_sha256,
            cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
            sha256(coalesce(string_agg(text, '' order by turn nulls first, text) filter (role = 'assistant'), '')) as loss_sha256,
            cast(sum(n + case when not opens then 6 else head + 1 + case role when 'assistant' then 7 else 13 end end) as bigint) as formatted_chars
        from r group by conv_id
    """,
    "pii_base_spans": f"""
        with t as (select row_number() over () as rn, doc_id, coalesce(text, '') as x from documents),
        f as ({_SQL_SPANS}),
        s as (select rn, kind, m, sum(length(g) + coalesce(length(m), 0)) over (partition by rn, kind order by i) as stop, regexp_replace(m, '[^0-9]', '', 'g') as ds from f),
        ok as (
            select rn, kind, stop - length(m) as start, stop from s where m is not null and case kind
                when 'email' then true
                when 'ip' then list_max(list_transform(string_split(m, '.'), lambda a: case when length(ltrim(a, '0')) > 3 then 999 else cast(a as bigint) end)) <= 255
                when 'phone' then length(ds) between 9 and 15
                else length(ds) between 13 and 19 and list_sum(list_transform(range(1, length(ds) + 1), lambda i:
                    case when i % 2 = 1 then cast(substr(reverse(ds), i, 1) as int) else (2 * cast(substr(reverse(ds), i, 1) as int)) % 10 + (2 * cast(substr(reverse(ds), i, 1) as int)) // 10 end)) % 10 = 0 end),
        n as (
            select rn, {", ".join(f"count(*) filter (kind = '{k}') as n_{k}" for k in pii.BASE_KINDS)},
                string_agg(concat(kind, ':', start, ':', stop), ',' order by case kind when 'email' then 1 when 'ip' then 2 when 'card' then 3 else 4 end, start) as told
            from ok group by rn)
        select doc_id, {", ".join(f"coalesce(n_{k}, 0) as n_{k}" for k in pii.BASE_KINDS)}, sha256(coalesce(told, '')) as base_sha256 from t left join n on t.rn = n.rn
    """,
    "quality_base_counts": f"""
        with d as (
            select row_number() over () as rn, doc_id, coalesce(text, '') as x, {_WORDS} as w,
                list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^ \\t-\\r]')) as ls from documents),
        e as (select rn, unnest(w) as word, generate_subscripts(w, 1) as i from d),
        k as (select rn, i, lead(word, 2) over o as last, concat_ws(' ', word, lead(word) over o, lead(word, 2) over o) as run from e window o as (partition by rn order by i)),
        m as (select rn, i, count(*) over (partition by rn, run) as n from k where last is not null),
        r as (select rn, count(distinct i + j) as n from m cross join (select unnest(range(3)) as j) where n > 1 group by rn)
        select doc_id, cast(len(w) as bigint) as n_words, cast(length(array_to_string(w, '')) as bigint) as word_chars,
            cast(length(regexp_replace(x, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols, cast(len(ls) - len(list_distinct(ls)) as bigint) as n_dup_lines,
            cast(coalesce(n, 0) as bigint) as n_repeat_words, len(w) < 50 or 100 * coalesce(n, 0) > 50 * len(w) as base_failed
        from d left join r on d.rn = r.rn
    """,
    "op12_source_divergence": r"""
        with d as (
            select row_number() over () as rn, coalesce(lang, '') as lang, coalesce(source, '') as source,
                list_transform(regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+'), lambda t: translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) as ts
            from documents),
        w as (select rn, lang, source, unnest(ts) as term from d),
        kept as (select lang, term from w group by lang, term having count(distinct rn) >= 30),
        v as (select lang, count(*) as terms from kept group by lang),
        held as (select lang, source, term, count(*) as n from w semi join kept using (lang, term) group by lang, source, term),
        g as (select distinct lang, source from d),
        every as (select g.lang, g.source, k.term, coalesce(n, 0) as n from g join kept k using (lang) left join held using (lang, source, term)),
        s as (
            select *, sum(n) over (partition by lang, source) as own, sum(n) over (partition by lang, term) as all_n, sum(n) over (partition by lang) as every_n from every),
        p as (
            select lang, source, term, n, 1 + (1000000000::hugeint * (n + 5)::hugeint) // (own + 5 * terms)::hugeint as p, 1 + (1000000000::hugeint * (all_n + 5)::hugeint) // (every_n + 5 * terms)::hugeint as q
            from s join v using (lang)),
        pairs as (
            select a.lang, a.source, b.source as item, coalesce(sum(abs(x.p - y.p)), 0) as value from g a join g b on a.lang = b.lang and a.source <> b.source
                left join p x on x.lang = a.lang and x.source = a.source left join p y on y.lang = b.lang and y.source = b.source and y.term = x.term
            group by all),
        ranked as (
            select lang, source, 'pair' as part, item, value, row_number() over (partition by lang, source order by value desc, item) as rank from pairs
            union all
            select lang, source, 'term', term, p - q, row_number() over (partition by lang, source order by p - q desc, term) from p where n > 0 and p > q)
        select lang, source, part, item, cast(value as bigint) as value, cast(rank as int) as rank from ranked where part = 'pair' or rank <= 50
    """,
    "op9_source_mixing": f"""
        with d as (
            select row_number() over () as rn, doc_id, cast(doc_id as varchar) as id, coalesce('1' || source, '2') as src, cast(len({_WORDS}) as bigint) as size,
                substr(md5(concat_ws(':', cast(doc_id as varchar), text)), 1, 15) as h from documents),
        s as (select src, cast(sum(size) as double) as n, cast([3, 1, 2][1 + (row_number() over (order by src) - 1) % 3] as double) as w from d group by src),
        l as (
            select *, (1.5::double * sum(n) over () - coalesce(sum(2 * n) over (order by 2 * n / w, src rows between unbounded preceding and 1 preceding), 0))
                / sum(w) over (order by 2 * n / w, src rows between current row and unbounded following) as level from s),
        t as (
            select src, cast(n as bigint) as source_size, least(2 * n, w * coalesce((select level from l where 2 * n / w > level order by 2 * n / w, src limit 1), 'infinity'::double)) as target
            from l),
        q as (select d.*, source_size, target, sum(size) over (partition by d.src order by h, id, size rows unbounded preceding) - size as before from d join t on d.src = t.src),
        v as (
            select rn, size, h, id, src, k, cast(before + k * source_size + size as double) / target as finish
            from q cross join (select unnest([0, 1]) as k) where size > 0 and before + k * source_size < target),
        g as (select rn, size, sum(size) over (order by finish, h, id, src, k rows unbounded preceding) - size as run from v),
        took as (select rn, sum(size) as taken from g where run < (select 1.5::double * sum(size) from d) group by rn)
        select doc_id, size, source_size, target, cast(coalesce(taken, 0) as bigint) as taken from q left join took on q.rn = took.rn
    """,
}
