"""Queries over the training-data operators, by problem number, and the SQL of those that SQL can state."""

from __future__ import annotations

import unicodedata

from weftline.llm import boilerplate, encode, history, mixing, pairs, pii, sentences, site_lines, terms
from weftline.runtime import table


def p1_found(spark, d):
    return terms.node_frequencies(table(spark, d, "baskets")).where("mark is not null").select("node_id", "mark")


def p1_term_frequencies(spark, d):
    return terms.node_frequencies(table(spark, d, "baskets"))


def _pages(spark, d):
    return table(spark, d, "docs"), table(spark, d, "feed_items"), table(spark, d, "feed_sources")


def p2_found(spark, d):
    return boilerplate.page_furniture(*_pages(spark, d))


def p2_main_bodies(spark, d):
    return boilerplate.main_bodies(*_pages(spark, d))


def p4_found(spark, d):
    return sentences.inner_starts(table(spark, d, "docs"), table(spark, d, "baskets"))


def p4_sentence_units(spark, d):
    texts = sentences.corpus_texts(table(spark, d, "docs"), table(spark, d, "baskets"))
    return sentences.sentence_units(texts)


def p5_found(spark, d):
    return history.repeated_items(*_pages(spark, d))


def p6_found(spark, d):
    return site_lines.repeated_lines(table(spark, d, "docs"))


def p6_blocks(spark, d):
    return site_lines.block_sizes(table(spark, d, "docs"))


def p6_cleaned_docs(spark, d):
    return site_lines.without_repeated_lines(table(spark, d, "docs"))


def p7_found(spark, d):
    return pairs.associated_pairs(table(spark, d, "baskets")).select("a", "b")


def p7_pair_scores(spark, d):
    return pairs.associated_pairs(table(spark, d, "baskets")).selectExpr("a", "b", "cooc", "round(npmi, 6) npmi", "round(lift, 6) lift")


def p8_ids(spark, d):
    return encode.token_ids(table(spark, d, "documents"))


def p9_draws(spark, d):
    targets = table(spark, d, "mix_targets")
    return mixing.draws(mixing.sized_documents(table(spark, d, "documents"), targets), targets)


def p9_mix_shares(spark, d):
    targets = table(spark, d, "mix_targets")
    sized = mixing.sized_documents(table(spark, d, "documents"), targets)
    return mixing.mix_shares(sized, mixing.draws(sized, targets), targets)


def p9_character_weights(spark, d):
    return mixing.character_weights(table(spark, d, "documents"), table(spark, d, "mix_targets")).selectExpr("source", "lang", "size", "round(weight, 6) weight")


def p10_found(spark, d):
    return pii.personal_mentions(table(spark, d, "documents"), table(spark, d, "name_list")).select("doc_id", "kind", "start_pos")


def p10_redacted(spark, d):
    return pii.redacted_documents(table(spark, d, "documents"), table(spark, d, "name_list"))


#: The full-width forms with their ASCII counterparts and the half-width kana with theirs: all of NFKC that the ids in baskets need.
WIDE = "".join(map(chr, range(0xFF01, 0xFF5F)))
ASCII = "".join(map(chr, range(0x21, 0x7F)))
_HALF = "".join(map(chr, range(0xFF61, 0xFFA0)))
_KANA = "".join(unicodedata.normalize("NFKC", c) for c in _HALF)
_VOICED = [(c + m, unicodedata.normalize("NFKC", c + m)) for m in "ﾞﾟ" for c in _HALF if len(unicodedata.normalize("NFKC", c + m)) == 1]


def _nfkc(x: str) -> str:
    for two, one in _VOICED:
        x = f"replace({x}, '{two}', '{one}')"
    return f"translate({x}, '{WIDE}{_HALF}', '" + ASCII.replace("'", "''") + _KANA + "')"


_BLANK = r"[\s\x{3000}\x{A0}]+"
_FOLD = f"lower(regexp_replace({_nfkc('node')}, '^{_BLANK}|{_BLANK}$', '', 'g'))"
_PAIRS = f"""
with folded as (
  select doc_id, unit, {_FOLD} as node_id from (select doc_id, unit, unnest(nodes) as node from baskets) where node is not null),
pairs as (select doc_id, unit, node_id, count(*) as occ from folded where node_id <> '' group by doc_id, unit, node_id),
kept as (select doc_id, unit from pairs group by all having min(node_id) < max(node_id)),
used as (select p.* from pairs p semi join kept k on p.doc_id is not distinct from k.doc_id and p.unit is not distinct from k.unit),
n as (select count(*) as n from kept),
freq as (select node_id, cast(sum(occ) as bigint) as occurrences, count(*) as df from used group by 1),
marked as (select node_id, occurrences, df, n as n_baskets,
  case when df < 4 then 'rare' when df > cast(0.05 as double) * n then 'common' end as mark from freq, n)
"""
_SCORED = _PAIRS + """,
cooc as (select x.node_id as a, y.node_id as b, count(*) as cooc from used x join used y
  on x.doc_id is not distinct from y.doc_id and x.unit is not distinct from y.unit and x.node_id < y.node_id group by all having count(*) >= 3),
scored as (select a, b, cooc, case when cooc = n then 1.0 else
   ln((cooc / n::double) / ((fa.df / n::double) * (fb.df / n::double))) / -ln(cooc / n::double) end as npmi,
   (cooc / n::double) / ((fa.df / n::double) * (fb.df / n::double)) as lift
  from cooc join freq fa on fa.node_id = a join freq fb on fb.node_id = b, n where fa.df >= 4 and fb.df >= 4)
"""
#: Fixed value: of NFKC, what the lines of docs hold beside full-width forms: half-width kana marks and such have no letters.
_LETTERS = "regexp_replace(lower(" + _nfkc("line") + "), '[^\\p{L}]', '', 'g')"
_SITE = f"""
one as (select doc_id, arg_min(source, path) as source, arg_min(body, path) as body from docs
  where doc_id is not null and source is not null group by doc_id),
lines as (select doc_id, source, unnest(string_split(body, chr(10))) as line, generate_subscripts(string_split(body, chr(10)), 1) as line_no from one where body is not null),
keyed as (select doc_id, source, line_no, {_LETTERS} as k from lines),
sizes as (select source, count(*) as n from one group by source),
hit as (select source, k from keyed where k <> '' group by source, k
  having count(distinct doc_id) >= 3),
big as (select source, k, count(distinct doc_id) as c from keyed semi join hit using (source, k) group by source, k),
found as (select doc_id, cast(line_no as int) as line_no from keyed join big using (source, k) join sizes using (source) where c >= cast(0.15 as double) * n)
"""
_CLEANED = """
select one.doc_id, one.source, case when one.body is null then null else coalesce(left_over.body, '') end as body,
  cast(coalesce(gone.n, 0) as int) as n_removed from one
  left join (select doc_id, string_agg(line, chr(10) order by line_no) as body from lines anti join found using (doc_id, line_no) group by doc_id) left_over using (doc_id)
  left join (select doc_id, count(*) as n from found group by doc_id) gone using (doc_id)
"""
#: Every block of every document by its identifiers, counted; the longest that counts at each line, unless the line before has one that covers it.
_BLOCKS = """,
seq as (select source, doc_id, list(k order by line_no) as ks from keyed where k <> '' group by source, doc_id),
starts as (select source, doc_id, ks, unnest(range(1, len(ks) + 1)) as i from seq),
every as (select source, doc_id, i, unnest(range(1, len(ks) - i + 2)) as n, ks from starts),
named as (select source, doc_id, i, n, array_to_string(ks[i:i + n - 1], chr(1)) as block from every),
counted as (select source, block, n, count(distinct doc_id) as docs from named group by all having count(distinct doc_id) >= 3),
good as (select named.*, docs from named join counted using (source, block, n) join sizes s using (source) where docs >= cast(0.15 as double) * s.n),
longest as (select source, doc_id, i, max(n) as n, arg_max(block, n) as block, arg_max(docs, n) as docs from good group by all),
kept as (select *, lag(i + n) over (partition by doc_id order by i) as last_end from longest),
each as (select source, n, docs, block, count(*) as c from kept where last_end is null or last_end < i + n group by all)
select source, cast(n as int) as n_lines, docs, count(*) as blocks, cast(sum(c) as bigint) as occurrences from each group by all
"""

QUERIES = {
    "p1_found": p1_found,
    "p1_term_frequencies": p1_term_frequencies,
    "p2_found": p2_found,
    "p2_main_bodies": p2_main_bodies,
    "p4_found": p4_found,
    "p4_sentence_units": p4_sentence_units,
    "p5_found": p5_found,
    "p6_found": p6_found,
    "p6_blocks": p6_blocks,
    "p6_cleaned_docs": p6_cleaned_docs,
    "p7_found": p7_found,
    "p8_ids": p8_ids,
    "p9_draws": p9_draws,
    "p9_mix_shares": p9_mix_shares,
    "p9_character_weights": p9_character_weights,
    "p10_found": p10_found,
    "p10_redacted": p10_redacted,
    "p7_pair_scores": p7_pair_scores,
}
#: Without language targets raking has this closed form.
_WEIGHTS = """
with listed as (select source, sum(target_share) as target_share, max(max_repeats) as max_repeats from mix_targets group by source),
sized as (select source, case when regexp_full_match(lower(trim(lang, ' ')[1:2]), '[a-z]{2}') then lower(trim(lang, ' ')[1:2]) else 'und' end as lang, coalesce(length(text), 0) as size
  from documents semi join listed using (source)),
cells as (select source, lang, cast(sum(size) as bigint) as size from sized group by all),
own as (select source, sum(size) as size from cells group by source),
total as (select sum(size) as total from own)
select c.source, c.lang, c.size, round(case when c.size = 0 then 0.0 else least(coalesce(target_share, 0) * total / o.size, coalesce(max_repeats, 1e300)) end, 6) as weight
from cells c join own o using (source) join listed using (source), total
"""

SQL = {
    "p9_character_weights": _WEIGHTS,
    "p6_found": "with" + _SITE + "select doc_id, line_no from found",
    "p6_cleaned_docs": "with" + _SITE + _CLEANED,
    "p6_blocks": "with" + _SITE + _BLOCKS,
    "p1_found": _PAIRS + "select node_id, mark from marked where mark is not null",
    "p1_term_frequencies": _PAIRS + "select * from marked",
    "p7_found": _SCORED + "select a, b from scored where npmi >= 0.25",
    "p7_pair_scores": _SCORED + "select a, b, cooc, round(npmi, 6) as npmi, round(lift, 6) as lift from scored where npmi >= 0.25",
}
