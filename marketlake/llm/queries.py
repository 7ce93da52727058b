"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.session import read_table

from . import bpe, chat, decontaminate, fill_middle, merkle, mixing, quality_fm
from . import quality_rules as qr
from . import secrets, simhash, suffix_dedup, url_filters, warc

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return deco


@register("op1_simhash_near_dedup")
def op1(spark: SparkSession, base: str) -> DataFrame:
    return simhash.simhash_components(read_table(spark, base, "documents")).select(
        "doc_id", "fingerprint", "component_id")


@register("op6_quality_rules", sql=f"""
with d as (select doc_id, coalesce(text, '') as t,
                  regexp_extract_all(coalesce(text, ''), '{qr.WORD}') as words,
                  string_split(coalesce(text, ''), chr(10)) as lines from documents),
win as (select doc_id, i, array_to_string(words[i:i + 4], ' ') as w
        from (select doc_id, words, unnest(range(1, len(words) - 3)) as i from d where len(words) >= 5)),
twice as (select doc_id, w from win group by all having count(*) > 1),
rep as (select doc_id, count(distinct p) as n
        from (select doc_id, unnest(range(i, i + 5)) as p from win join twice using (doc_id, w)) group by doc_id),
line as (select doc_id, l, regexp_matches(l, '[^\\x20\\x09-\\x0D]') as filled,
                len(regexp_extract_all(l, '{qr.MARKS}')) as marks,
                len(regexp_extract_all(l, '{qr.SEPARATOR}')) as cells,
                len(regexp_extract_all(l, '{qr.WORD}')) as n
         from (select doc_id, unnest(lines) as l from d)),
judged as (select doc_id, l, filled, filled and ((cells >= {qr.MIN_SEPARATORS} and n <= {qr.MAX_CELL_WORDS} * (cells + 1))
                  or regexp_matches(l, '{qr.BOILERPLATE}') or (marks >= {qr.MIN_MARKS} and 4 * marks >= n)
                  or (not regexp_matches(l, '{qr.CLAUSE}') and n >= {qr.MIN_UNPUNCTUATED_WORDS})) as fails
           from line),
per as (select doc_id, count(*) filter (filled) - count(distinct l) filter (filled) as dup,
               coalesce(sum(length(regexp_replace(l, '{qr.BLANK}+', '', 'g'))) filter (fails), 0) as lost
        from judged group by doc_id),
base as (select d.doc_id, len(words)::bigint as n_words,
                length(regexp_replace(t, '{qr.BLANK}+', '', 'g'))::bigint as word_chars,
                len(regexp_extract_all(t, '{qr.SYMBOLS}'))::bigint as n_symbols,
                per.dup::bigint as n_dup_lines, coalesce(rep.n, 0)::bigint as n_repeat_words, lost
         from d join per using (doc_id) left join rep using (doc_id)),
f as (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from base)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and 100 * lost <= {qr.MAX_LOST_PERCENT} * word_chars as kept from f
""")
def op6(spark: SparkSession, base: str) -> DataFrame:
    return qr.judge_lines(read_table(spark, base, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@register("op3_source_mixing")
def op3(spark: SparkSession, base: str) -> DataFrame:
    pieces = mixing.mix_pieces(read_table(spark, base, "documents"))
    return mixing.mix_summary(pieces).select("doc_id", "size", "source_size", "target", "taken")


@register("op4_secret_scans")
def op4(spark: SparkSession, base: str) -> DataFrame:
    found = secrets.scan_secrets(read_table(spark, base, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex",
                        F.sha2(secrets.joined(F.col("base")), 256).alias("base_sha256"),
                        secrets.joined(F.col("spans")).alias("spans"))


@register("op7_url_filters", sql=r"""
with recursive
part as (select page_id, url, html, coalesce(url, '') as u, position('://' in coalesce(url, '')) as pos from pages),
tail as (select page_id, url, html, case when pos > 0 then substr(u, pos + 3) else '' end as rest from part),
p as (select page_id, html, url,
             translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path,
             regexp_extract(rest, '^[^/?#]*([^#]*)', 1) as tail from tail),
rules(rule, rhost, rpath, said) as (values ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
             ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
link as (select host || tail as a, replace(t, '&amp;', '&') as t from (
             select host, tail, unnest([
               regexp_extract(regexp_extract(html, '(?i)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>'),
                              '(?i)\bhref\s*=\s*["'']?([^"''\s>]+)', 1),
               regexp_extract(regexp_extract(html, '(?i)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>'),
                              '(?i)\burl\s*=\s*["'']?([^"''\s>]+)', 1)]) as t
             from p where host <> '') where regexp_matches(t, '(?i)^https?://[^/?#]')),
edge as (select a, translate(regexp_extract(substr(t, position('://' in t) + 3), '^[^/?#]*'),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
                   || regexp_extract(substr(t, position('://' in t) + 3), '^[^/?#]*([^#]*)', 1) as b from link),
both_ways as (select a, b from edge union select b, a from edge),
reach as (select a, b from both_ways union select reach.a, w.b from reach join both_ways w on w.a = reach.b),
node_rule as (select node, arg_max(said, length(rule)) as said
              from (select distinct b as node from reach) n join rules
                on (split_part(regexp_extract(node, '^[^/?#]*'), '/', 1) = rhost
                    or ends_with(regexp_extract(node, '^[^/?#]*'), '.' || rhost))
               and starts_with(regexp_extract(node, '^[^/?#]*([^?#]*)', 1), rpath) group by node),
alias as (select reach.a as node, case when bool_or(said = 'allow') then 'allow' when bool_or(said = 'block') then 'block'
                 else 'allow' end as verdict
          from reach left join node_rule on node_rule.node = reach.b group by reach.a),
own as (select page_id, host, path, host || tail as node, arg_max(rule, length(rule)) as rule, arg_max(said, length(rule)) as said
        from p left join rules on (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath)
        group by page_id, host, path, tail)
select page_id, host, path, rule, coalesce(said, alias.verdict, 'allow') as verdict
from own left join alias using (node)
""")
def op7(spark: SparkSession, base: str) -> DataFrame:
    return url_filters.judge_urls(read_table(spark, base, "pages")).select("page_id", "host", "path", "rule", "verdict")


@register("op10_chat_formatting", sql=r"""
with c as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
           union all select -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
           union all select -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
e as (select *, regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g') as etext,
             regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '<(\\*)\|', '<\1\\|', 'g') as erole from c)
select conv_id, count(*)::bigint as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
       sum(length('<|im_start|>' || erole || chr(10) || etext || '<|im_end|>' || chr(10)))::bigint as formatted_chars
from e group by conv_id
""")
def op10(spark: SparkSession, base: str) -> DataFrame:
    rows = chat.with_control_conversation(read_table(spark, base, "conversations"))
    return chat.digest(chat.format_conversations(rows))


@register("op2_quality_classifier")
def op2(spark: SparkSession, base: str) -> DataFrame:
    return quality_fm.score_quality(read_table(spark, base, "documents"), read_table(spark, base, "labels"))


@register("op5_warc", sql="""
with p as (select page_id, coalesce(html, '') as html from pages),
d as (select page_id, octet_length(encode(html))::bigint as payload_bytes, sha1(html) as payload_digest from p),
m as (select payload_digest, max(page_id) as top from d where payload_bytes >= 1000 group by 1)
select page_id, payload_bytes, payload_digest,
       case when payload_bytes >= 1000 and page_id < top then 'revisit' else 'response' end as record_type,
       case when payload_bytes >= 1000 and page_id < top then top end as refers_to
from d left join m using (payload_digest)
""")
def op5(spark: SparkSession, base: str) -> DataFrame:
    return warc.archive_pages(read_table(spark, base, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@register("op8_benchmark_decontamination")
def op8(spark: SparkSession, base: str) -> DataFrame:
    return decontaminate.find_contamination(read_table(spark, base, "documents"), read_table(spark, base, "benchmark"))


@register("op9_suffix_array_dedup")
def op9(spark: SparkSession, base: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read_table(spark, base, "documents"))


@register("op11_bpe")
def op11(spark: SparkSession, base: str) -> DataFrame:
    import public_tokenizers
    docs = read_table(spark, base, "documents").select("doc_id", "text")
    return bpe.tokenize(docs, public_tokenizers.path("byte_bpe_50k.json")).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@register("op13_fill_in_middle", sql="""
with d as (select doc_id, coalesce(text, '') as t, sha256('1:' || coalesce(cast(doc_id as varchar), '')) as s from documents),
h as (select doc_id, t, length(t)::bigint as n, cast('0x' || s[1:8] as bigint) as h1, cast('0x' || s[9:16] as bigint) as h2,
             cast('0x' || s[17:24] as bigint) as h3, cast('0x' || s[25:32] as bigint) as h4 from d),
c as (select doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
             case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 90 then 'plain'
                  when h4 % 100 < 20 then 'spm' else 'psm' end as form from h),
p as (select *, substring(t, 1, a) as pre, substring(t, a + 1, b - a) as mid, substring(t, b + 1, n - b) as suf from c)
select doc_id, n, form, case when form <> 'plain' then a end as prefix_chars, case when form <> 'plain' then b - a end as middle_chars,
       sha256(case form when 'plain' then t when 'psm' then '<P>' || pre || '<S>' || suf || '<M>' || mid
              else '<S>' || suf || '<P>' || pre || '<M>' || mid end) as output_sha256, sha256(t) as restored_sha256 from p
""")
def op13(spark: SparkSession, base: str) -> DataFrame:
    made = fill_middle.fill_in_middle(read_table(spark, base, "documents").select("doc_id", "text"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(fill_middle.restore_text(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


@register("op12_merkle_manifest", sql=r"""
with recursive
v as (select doc_id, source, text, coalesce(octet_length(encode(cast(doc_id as varchar))) || ':' || doc_id, '-') as a,
             coalesce(octet_length(encode(source)) || ':' || source, '-') || coalesce(octet_length(encode(lang)) || ':' || lang, '-')
             || coalesce(octet_length(encode(cast(n_chars as varchar))) || ':' || n_chars, '-') as b,
             replace(text, chr(10), '') as cut,
             list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(cast(doc_id as varchar), ''), lambda s: ascii(s)::bigint)),
                         lambda c, byte: list_reduce(list_prepend(xor(c, byte), range(8)),
                                                     lambda x, i: xor(x // 2, (x % 2) * 3988292384::bigint))) as register
      from documents),
leafs as (select doc_id, source, sha256(a || b || coalesce(octet_length(encode(text)) || ':' || text, '-')) as leaf,
                 case when xor(register, 4294967295::bigint) % 2 = 0
                      then sha256(a || b || coalesce(octet_length(encode(cut)) || ':' || cut, '-')) end as tampered from v),
ranked as (select *, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as idx,
                  count(*) over (partition by source) as n from leafs),
tree as (select source, 0 as level, idx, n, leaf as digest from ranked
         union all
         select source, level + 1, idx // 3, (max(n) + 2) // 3, sha256(string_agg(digest, '' order by idx))
         from tree where n > 1 group by source, level, idx // 3),
subroots as (select source, level as top, digest, row_number() over (order by source nulls first) - 1 as idx, count(*) over () as n
             from tree where n = 1),
crown as (select 0 as level, idx, n, digest from subroots
          union all
          select level + 1, idx // 3, (max(n) + 2) // 3, sha256(string_agg(digest, '' order by idx))
          from crown where n > 1 group by level, idx // 3),
nodes as (select source, level, idx, n, digest from tree where n > 1
          union all
          select s.source, s.top + c.level, c.idx, c.n, c.digest from subroots s, crown c where c.n > 1),
runs as (select source, level, idx // 3 as run, list(idx order by idx) as places, list(digest order by idx) as digests
         from nodes group by all),
climb as (select doc_id, r.source, leaf, 0 as level, r.idx, coalesce(tampered, leaf) as folded, '' as proof, r.idx as leaf_idx from ranked r
          union all
          select doc_id, c.source, leaf, c.level + 1, case when c.level + 1 = s.top then s.idx else p.idx // 3 end,
                 sha256(array_to_string(list_transform(list_zip(u.places, u.digests), lambda z: case when z[1] = p.idx then folded else z[2] end), '')),
                 proof || array_to_string(list_transform(list_filter(list_zip(u.places, u.digests), lambda z: z[1] <> p.idx), lambda z: z[2]), ''),
                 leaf_idx
          from climb c join subroots s on s.source is not distinct from c.source
          cross join lateral (select case when c.level = s.top then s.idx else c.idx end as idx) p
          join runs u on u.source is not distinct from c.source and u.level = c.level and u.run = p.idx // 3),
ends as (select doc_id, source, leaf, leaf_idx, arg_max(folded, level) as folded_root, arg_max(proof, level) as proof
         from climb group by all)
select e.doc_id, e.leaf, s.digest as subroot, (select digest from crown where n = 1) as root, sha256(e.proof) as proof_sha256,
       e.folded_root, e.folded_root = (select digest from crown where n = 1) as verified
from ends e join subroots s on s.source is not distinct from e.source
""")
def op12(spark: SparkSession, base: str) -> DataFrame:
    return merkle.verify_tampered(read_table(spark, base, "documents"))
