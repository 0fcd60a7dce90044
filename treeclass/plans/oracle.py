"""Oracle SQL (DuckDB dialect) for the registered queries.

One shared ``WITH`` prefix restates the fixture rules, then each key selects
from it.  The text is straightforward per-row / per-position SQL with no
optimisation, so it is an independent check of the Spark plans (e.g. the
per-word shortcut of ``process_title`` is checked against the per-position
analyser chain here).  Unused CTEs are not evaluated.
"""

from __future__ import annotations

H = "('0x' || substr(md5({x}), 1, 8))::bigint"

# The dropped tags, stated here on their own (not imported from the engine).
TAG_DROPPED = """tag_id in (592, 151, 0, 235, 800, 573, 148, 99, 97, 801)
  or tag_id between 429 and 461 or tag_id between 462 and 508 or tag_id between 705 and 723
  or tag_id between 594 and 598 or tag_id between 578 and 591"""


def _level(n: int, routes: str) -> str:
    return f"""
m{n} as (
  select r.id, r.node, w.idx, round(sum(w.w), 6) as margin
  from {routes} r join bag b on b.id = r.id
  join weights w on w.node = r.node and w.feature = b.term
  group by r.id, r.node, w.idx),
b{n} as (
  select id, node, idx, margin from (
    select *, row_number() over (partition by id, node order by margin desc, idx) as rn
    from m{n} where margin > 0) z where rn = 1),
s{n} as (
  select r.id, r.node, coalesce(b.idx, 0) as idx, coalesce(b.margin, 0.0) as margin,
         1 / (1 + exp(-coalesce(b.margin, 0.0))) as confidence
  from {routes} r left join b{n} b on r.id = b.id and r.node = b.node),
c{n} as (
  select s.id, s.node, s.idx, x.id as category, s.margin, s.confidence
  from s{n} s left join category_index x on x.parent_id = s.node and x.idx = s.idx)"""


PREFIX = r"""
with recursive
docs as (select doc_id as id, text as title, lang, source, n_chars from documents),
ad_labels as (
  select d.doc_id as id, 10 + l1 as cat1,
         case when feed >= 18 then null else 100 + l1 * 10 + feed % 3 end as cat2,
         case when feed >= 18 or q is null then null else 1000 + l1 * 100 + (feed % 3) * 10 + q end as cat3
  from (select doc_id,
               case lang when 'de' then 1 when 'en' then 2 when 'es' then 3 else 4 end as l1,
               cast(substr(source, 4) as int) as feed
        from documents) d
  left join (select doc_id, quality as q from labels) l on d.doc_id = l.doc_id),
category as (
  select distinct id, parent_id, concat('category ', id) as name from (
    select cat1 as id, 0 as parent_id from ad_labels
    union all select cat2, cat1 from ad_labels
    union all select cat3, cat2 from ad_labels) x
  where id is not null),
category_index as (
  select parent_id, id, cast(row_number() over (partition by parent_id order by id) - 1 as int) as idx
  from category),
closure(id, anc, hops) as (
  select id, id, 0 from category
  union all
  select c.id, t.parent_id, c.hops + 1 from closure c join category t on c.anc = t.id
  where t.parent_id <> 0),
depth as (select id, cast(max(hops) + 1 as int) as depth from closure group by id),
toks as (select id, regexp_extract_all(title, '\p{L}+') as t from docs),
words as (
  select id, cast(node as int) as start_node, orth from (
    select id, unnest(t) as orth, unnest(range(1, len(t) + 1)) as node from toks) u),
vocab as (select distinct orth from words),
lexicon as (
  select orth, 1 as ordinal, 1 as segment, case when length(orth) >= 10 then 2 else 1 end as end_segment, orth as surface,
         case when length(orth) <= 2 then ([592, 151, 235, 429, 445, 461, 800, 462, 485, 508, 705, 714, 723, 594,
                                            596, 598, 573, 578, 585, 591, 148, 99, 97, 801])[__H_ORTH__ % 24 + 1]
              when length(orth) in (3, 10) then 592
              else ([300, 593, 150, 152, 234, 236, 428, 509, 799, 802, 704, 724, 599, 572, 574, 577, 147, 149, 98,
                     100, 96])[__H_ORTH__ % 21 + 1] end as tag_id,
         case when length(orth) > 4 and suffix(orth, 's')
              then concat(substr(orth, 1, length(orth) - 1), ':s2') else orth end as lemma
  from vocab where length(orth) < 12
  union all
  select orth, 2, 1, 1, orth, 301, concat(orth, ':alt') from vocab where length(orth) = 3
  union all
  select orth, 2, 1, 1, substr(orth, 1, 5), 149, concat(substr(orth, 1, 5), ':p') from vocab where length(orth) in (10, 11)
  union all
  select orth, 3, 2, 2, substr(orth, 6), 100, concat(substr(orth, 6), ':q') from vocab where length(orth) in (10, 11)),
stop as (select orth from (values ('with'), ('that'), ('they'), ('avec'), ('pour'), ('auch')) v(orth)),
tokens as (
  select w.id, cast(w.node + coalesce(l.segment, 1) - 1 as int) as start_node,
         cast(w.node + coalesce(l.end_segment, 1) as int) as end_node, coalesce(l.surface, w.orth) as orth,
         coalesce(l.lemma, w.orth) as lemma, coalesce(l.tag_id, 0) as tag_id, coalesce(l.ordinal, 1) as ordinal
  from (select id, orth, 1 + coalesce(sum(case when length(orth) in (10, 11) then 2 else 1 end)
               over (partition by id order by start_node rows between unbounded preceding and 1 preceding), 0) as node
        from words) w left join lexicon l on w.orth = l.orth),
kept_tags as (select * from tokens where not (__TAG_DROPPED__)),
kept as (select * from kept_tags t where not exists (select 1 from stop s where s.orth = t.orth)),
first_lemma as (
  select id, start_node, min_by(split_part(lemma, ':', 1), ordinal) as lemma
  from kept group by id, start_node),
bag as materialized (select distinct id, lemma as term from first_lemma),
ad_cat as (
  select id, cat1 as cat from ad_labels
  union all select id, cat2 from ad_labels where cat2 is not null
  union all select id, cat3 from ad_labels where cat3 is not null),
cat_terms as (select distinct a.cat, b.term from ad_cat a join bag b on a.id = b.id),
weights as (
  select x.parent_id as node, x.idx, t.term as feature,
         cast(__H_KEY__ % 2001 - 1000 as double) / 1000 as w
  from cat_terms t join category_index x on x.id = t.cat where x.idx > 0),
node_rows as (
  select id, 0 as node, 1 as level, cat1 as category from ad_labels where cat1 is not null
  union all select id, cat1, 2, cat2 from ad_labels where cat2 is not null
  union all select id, cat2, 3, cat3 from ad_labels where cat3 is not null),
node_counts as (select node, level, count(*) as n_rows from node_rows group by node, level),
child_counts as (select parent_id as node, cast(count(*) as int) as num_classes from category group by parent_id),
models as (
  select n.node, n.level, c.num_classes, n.n_rows from node_counts n join child_counts c on n.node = c.node
  where c.num_classes > 0 and n.n_rows > 0),
encoded as (
  select a.id, a.cat1, a.cat2, a.cat3,
         coalesce(x1.idx, -1) as l1_idx, coalesce(x2.idx, -1) as l2_idx, coalesce(x3.idx, -1) as l3_idx
  from ad_labels a
  left join category_index x1 on x1.parent_id = 0 and x1.id = a.cat1
  left join category_index x2 on x2.parent_id = a.cat1 and x2.id = a.cat2
  left join category_index x3 on x3.parent_id = a.cat2 and x3.id = a.cat3),
tf as materialized (
  select id, cast(__H_TERM__ % 30720 as int) as bucket, count(*) as tf from bag group by 1, 2),
n_docs as (select count(*) as m from docs),
idf as materialized (
  select bucket, count(*) as df, ln((n_docs.m + 1.0) / (count(*) + 1.0)) as idf
  from tf, n_docs group by bucket, n_docs.m),
tfidf as (select t.id, t.bucket, t.tf * i.idf as value from tf t join idf i on t.bucket = i.bucket),
label_routes as (
  select r.id, r.node from (
    select id, 0 as node from ad_labels
    union all select id, cat1 from ad_labels where cat2 is not null
    union all select id, cat2 from ad_labels where cat3 is not null) r
  where r.node in (select node from models)),
r1 as (select id, 0 as node from docs where 0 in (select node from models where level = 1)),
__L1__,
r2 as (select id, category as node from c1
       where confidence >= 0.7 and category in (select node from models where level = 2)),
__L2__,
r3 as (select id, category as node from c2
       where confidence >= 0.8 and category in (select node from models where level = 3)),
__L3__,
__LR__,
cascade as (
  select p1.id, p1.category as cat1_pred, p1.confidence as conf1, p2.category as cat2_pred,
         p2.confidence as conf2, p3.category as cat3_pred, p3.confidence as conf3
  from c1 p1 left join c2 p2 on p1.id = p2.id left join c3 p3 on p1.id = p3.id),
decoded as (
  select id,
         cast(case when cat2_pred is null then 0 when coalesce(conf3, -1) < 0.9 then 2 else 3 end as int) as depth,
         cast(case when cat2_pred is null then 0 when coalesce(conf3, -1) < 0.9 then cat2_pred
              else cat3_pred end as int) as category
  from cascade),
pos as (
  select c.id as a, c.anc, case when c.hops = 0 then 0 else c.hops + 1 end as p
  from closure c join depth d on c.id = d.id where c.hops = 0 or c.hops <= d.depth - 2
  union all select id, 0, depth from depth),
up as (select id as b, anc, hops from closure union all select id, 0, depth from depth),
selective as (
  select sum(case when d.depth <> 0 and d.category = case d.depth when 1 then a.cat1 when 2 then a.cat2
                  when 3 then a.cat3 end then 1 else 0 end) as n_correct,
         sum(case when d.depth <> 0 then 1 else 0 end) as n_resolved
  from decoded d join ad_labels a on a.id = d.id),
root_pred as (
  select l.id, e.cat1, e.l1_idx, l.idx, l.category from lr l join encoded e on e.id = l.id where l.node = 0),
__END__ as (select 1)
"""

PREFIX = (PREFIX.replace("__TAG_DROPPED__", TAG_DROPPED)
          .replace("__H_KEY__", H.format(x="concat(t.cat, ':', t.term)"))
          .replace("__H_TERM__", H.format(x="term"))
          .replace("__H_ORTH__", H.format(x="orth"))
          .replace("__L1__", _level(1, "r1").strip().rstrip(","))
          .replace("__L2__", _level(2, "r2").strip().rstrip(","))
          .replace("__L3__", _level(3, "r3").strip().rstrip(","))
          .replace("__LR__", _level(9, "label_routes").strip().rstrip(",")
                   + ",\nlr as (select * from c9)")
          .replace(",\n__END__ as (select 1)\n", "\n"))

SELECTS = {
    # sources / sinks
    "scan_ads_training": """
select d.id, regexp_replace(d.title, '[\\t\\r\\n]', ' ', 'g') as title, a.cat1, a.cat2, a.cat3
from docs d join ad_labels a on a.id = d.id""",
    "scan_ads_test": """
select id, regexp_replace(title, '[\\t\\r\\n]', ' ', 'g') as title, -1 as cat1, -1 as cat2, -1 as cat3
from docs""",
    "scan_categories": "select id, parent_id, name from category",
    "scan_stopwords": "select orth from vocab",
    "sink_predictions": "select id, category from decoded",
    "sink_metrics": """
select 'n_correct' as metric, cast(n_correct as double) as value from selective
union all select 'n_resolved', cast(n_resolved as double) from selective
union all select 'selective_accuracy', round(n_correct / n_resolved, 9) from selective""",
    "model_roundtrip": """
select m.node, m.level, m.num_classes, coalesce(w.n, 0) as n_weights
from models m left join (select node, count(*) as n from weights group by node) w on w.node = m.node""",
    # taxonomy
    "categories_level": """
select c.id, c.parent_id, d.depth as level from category c join depth d on c.id = d.id""",
    "category_index": "select parent_id, id, idx from category_index",
    "category_closure": "select id, anc, hops from closure",
    "category_tour": """
with paths(id, depth, path) as (
  select cast(0 as int), cast(0 as int), [0]
  union all select c.id, p.depth + 1, list_append(p.path, c.id) from paths p join category c on c.parent_id = p.id),
ranked as (select id, depth, path, row_number() over (order by path) - 1 as rank from paths)
select r.id, r.depth, 2 * r.rank - r.depth as enter,
       2 * r.rank - r.depth + 2 * (select count(*) from paths p where list_contains(p.path, r.id)) - 1 as leave
from ranked r""",
    "l2_children": """
select parent_id, cast(count(*) as int) as n_children, string_agg(cast(id as varchar), ',' order by id) as children
from category where parent_id in (select id from category where parent_id = 0) group by parent_id""",
    "category_list": "select cast(row_number() over (order by id) - 1 as int) as pos, id from category",
    "category_map_for_parent": """
select id, cast(row_number() over (order by id) - 1 as int) as idx
from (select distinct cat2 as id from ad_labels where cat2 is not null) s""",
    "category_map_by_parent": """
select parent_id, id, cast(row_number() over (partition by parent_id order by id) - 1 as int) as idx
from (select distinct cat2 as parent_id, cat3 as id from ad_labels where cat3 is not null) s""",
    "dedupe_last": """
select source, max_by(lang, doc_id) as lang from documents group by source""",
    # encoding
    "ads_label_encode": "select * from encoded",
    "ads_flat_label": """
select a.id, a.cat2 as category, cast(m.idx as double) as label
from ad_labels a join (select id, row_number() over (order by id) - 1 as idx
                       from (select distinct cat2 as id from ad_labels where cat2 is not null) s) m
on m.id = a.cat2""",
    "deepest_category": "select id, coalesce(cat3, cat2, cat1) as category from ad_labels",
    "node_training_set": "select node, level, n_rows from node_counts",
    "node_training_rows": """
select r.node, r.level, count(*) as n_rows, cast(sum(case when x.id is null then 1 else 0 end) as bigint) as n_unknown
from node_rows r left join (select * from category_index where id < 1000 or id % 10 = 0) x
on x.parent_id = r.node and x.id = r.category group by r.node, r.level""",
    "unknown_labels": """
select count(*) as n_rows, cast(0 as bigint) as unknown1, cast(0 as bigint) as unknown2,
       cast(sum(case when level = 3 and category % 10 <> 0 then 1 else 0 end) as bigint) as unknown3 from node_rows""",
    "random_split": """
select count(*) as n_rows, cast(1 as bigint) as most_parts, cast(1 as bigint) as fewest_parts, true as near_60_percent
from ad_labels where cat2 is not null""",
    "trainable_nodes": "select node, level, num_classes, n_rows from models",
    "train_test_split": f"select id, {H.format(x='cast(id as varchar)')} % 100 < 60 as is_train from ad_labels",
    # scalar functions
    "scalar_string": """
select id, string_split(line, '\t')[2] as lang, split_part(line, '\t', 4) as source,
       cast(len(string_split(line, '\t')) as int) as n_parts, string_split(line, '\t')[3] = '' as third_empty
from (select doc_id as id, concat_ws('\t', cast(doc_id as varchar), lang, '', source) as line from documents) x""",
    "scalar_cast": """
select doc_id as id, cast(substr(source, 4) as int) as feed, cast(doc_id as varchar) as id_str,
       cast(cast(doc_id as varchar) as bigint) as id_back, try_cast(lang as int) as lang_num,
       cast(n_chars as double) as n_chars_d
from documents""",
    "scalar_array": """
select t.id, cast(len(t.t) as int) as n_tokens, list_contains(t.t, 'the') as has_the,
       cast(coalesce(list_position(t.t, 'the'), 0) as bigint) as pos_the, t.t[-1] as last_token,
       cast(len(list_distinct(t.t)) as int) as n_distinct,
       cast(coalesce(w.n_long, 0) as int) as n_long, cast(coalesce(w.total_len, 0) as bigint) as total_len,
       cast(len(t.t) + 1 as int) as n_appended
from toks t left join (select id, sum(case when length(orth) > 6 then 1 else 0 end) as n_long,
                              sum(length(orth)) as total_len from words group by id) w on w.id = t.id""",
    "scalar_map": """
select parent_id, max(case when idx = 0 then id end) as first_child, cast(count(*) as int) as n_classes,
       bool_or(idx = 1) as has_second, max(id) as max_child
from category_index group by parent_id""",
    "scalar_arith": """
select doc_id as id, n_chars * 2 + 1 as a, round(n_chars / 7, 6) as b, n_chars % 7 as c,
       n_chars // 7 as d, n_chars > 1000 and lang = 'en' as e
from documents""",
    "scalar_format": """
select node, printf('model/logistic_regression_%d_%d_%s_%d', num_classes, 10, '0.01', node) as model_path,
       strftime(timestamp '2017-01-02 03:04:05.678', '%Y-%m-%d_%H-%M-%S-%g') as stamp
from models""",
    # text
    "annotate_tokens": "select id, start_node, end_node, orth, lemma, tag_id, ordinal from tokens",
    "tag_filter": "select id, start_node, end_node, orth, lemma, tag_id, ordinal from kept_tags",
    "stopword_anti_join": "select id, start_node, end_node, orth, lemma, tag_id, ordinal from kept",
    "first_lemma": "select id, start_node, lemma from first_lemma",
    "lemma_base": "select orth, ordinal, lemma, split_part(lemma, ':', 1) as base from lexicon",
    "process_title": "select id, term from bag",
    # features
    "hashing_tf": "select id, bucket, tf from tf",
    "stage_title_terms": "select id, bucket, tf from tf",
    "idf": "select bucket, df, round(idf, 9) as idf from idf",
    "node_idf": """
select r.node, t.bucket, count(*) as df, m.n_rows as n_docs, round(ln((m.n_rows + 1.0) / (count(*) + 1.0)), 9) as idf
from node_rows r join tf t on t.id = r.id join node_counts m on m.node = r.node group by r.node, t.bucket, m.n_rows""",
    "idf_union_corpus": """
with turns as (select -(conv_id * 1000 + turn) - 1 as id, text as title from conversations),
turn_words as (select distinct id, unnest(regexp_extract_all(title, '\\p{L}+')) as orth from turns),
turn_lemma as (
  select l.orth, min_by(split_part(l.lemma, ':', 1), l.ordinal) as lemma
  from lexicon l where not (__TAG_DROPPED__) and l.surface not in (select orth from stop) group by l.orth, l.segment),
turn_bag as (select distinct w.id, l.lemma as term from turn_words w join turn_lemma l on l.orth = w.orth),
both_tf as (
  select id, cast(__H_TERM__ % 30720 as int) as bucket, count(*) as tf
  from (select id, term from bag union all select id, term from turn_bag) u group by 1, 2),
m as (select (select count(*) from docs) + (select count(*) from turns) as m)
select b.bucket, b.df, round(ln((m.m + 1.0) / (b.df + 1.0)), 9) as idf, coalesce(i.df, 0) as df_documents
from (select bucket, count(*) as df from both_tf group by bucket) b cross join m
left join idf i on i.bucket = b.bucket""",
    "features_join": """
select e.id, e.l1_idx, e.l2_idx, e.l3_idx, count(*) as n_terms, round(sum(t.value), 6) as tfidf_sum
from encoded e join tfidf t on t.id = e.id group by e.id, e.l1_idx, e.l2_idx, e.l3_idx""",
    "labeled_features": """
select e.id, cast(e.l1_idx as double) as label, cast(coalesce(v.nnz, 0) as int) as nnz,
       round(coalesce(v.norm, 0.0), 6) as norm
from encoded e left join (select id, sum(case when value <> 0 then 1 else 0 end) as nnz,
                                 sqrt(sum(value * value)) as norm from tfidf group by id) v on v.id = e.id
where e.l1_idx >= 0""",
    # scoring
    "sigmoid_confidence": "select id, margin, round(confidence, 6) as confidence from c1",
    "linear_score": "select id, node, idx, category, margin, round(confidence, 6) as confidence from lr",
    "linear_score_intercept": """
with all_margins as (
  select d.id, x.idx, round(coalesce(sum(w.w), 0) + (x.idx - 2) / 4.0, 6) as margin
  from docs d cross join (select idx from category_index where parent_id = 0 and idx > 0) x
  left join bag b on b.id = d.id left join weights w on w.node = 0 and w.idx = x.idx and w.feature = b.term
  group by d.id, x.idx),
top as (select id, idx, margin, row_number() over (partition by id order by margin desc, idx) as rn
        from all_margins where margin > 0)
select d.id, cast(coalesce(t.idx, 0) as int) as idx, x.id as category, coalesce(t.margin, 0.0) as margin,
       round(1 / (1 + exp(-coalesce(t.margin, 0.0))), 6) as confidence
from docs d left join top t on t.id = d.id and t.rn = 1
left join category_index x on x.parent_id = 0 and x.idx = coalesce(t.idx, 0)""",
    "linear_score_node_idf": """
with own_idf as (
  select r.node, b.term, ln((m.n_rows + 1.0) / (count(*) + 1.0)) as idf
  from node_rows r join bag b on b.id = r.id join node_counts m on m.node = r.node group by r.node, b.term, m.n_rows),
own_margins as (
  select r.id, r.node, w.idx, round(sum(w.w * i.idf), 6) as margin
  from label_routes r join bag b on b.id = r.id join weights w on w.node = r.node and w.feature = b.term
  join own_idf i on i.node = r.node and i.term = b.term group by r.id, r.node, w.idx),
own_best as (
  select id, node, idx, margin from own_margins where margin > 0
  qualify row_number() over (partition by id, node order by margin desc, idx) = 1)
select r.id, r.node, x.id as category, coalesce(b.margin, 0.0) as margin
from label_routes r left join own_best b on b.id = r.id and b.node = r.node
left join category_index x on x.parent_id = r.node and x.idx = coalesce(b.idx, 0)""",
    "linear_score_runmax": """
select id, node, idx, cast(case when idx > 0 then 0.5 else 0.0 end as double) as confidence from lr""",
    "linear_predict": "select id, node, cast(idx as double) as prediction from lr",
    "cascade_predict": """
select id, cat1_pred, round(conf1, 6) as conf1, cat2_pred, round(conf2, 6) as conf2,
       cat3_pred, round(conf3, 6) as conf3 from cascade""",
    "cascade_decode": "select id, depth, category from decoded",
    "cascade_decode_no_root_model": "select id, cast(0 as int) as depth, cast(0 as int) as category from docs",
    "stream_cascade_decode": "select id, depth, category from decoded",
    "stage_hierarchy_model": "select id, depth, category from decoded",
    "cascade_decode_level1": """
select id,
       cast(case when cat2_pred is null and conf1 >= 0.7 then 1 when cat2_pred is null then 0
                 when coalesce(conf3, -1) < 0.9 then 2 else 3 end as int) as depth,
       cast(case when cat2_pred is null and conf1 >= 0.7 then cat1_pred when cat2_pred is null then 0
                 when coalesce(conf3, -1) < 0.9 then cat2_pred else cat3_pred end as int) as category
from cascade""",
    # evaluation
    "category_cost": """
select p.a, p.b, case when p.a = p.b then 0 else (
         select cast(min_by(u.hops + 2 * q.p, u.hops) as int) from pos q join up u on q.anc = u.anc
         where q.a = p.a and u.b = p.b) end as cost
from (select distinct coalesce(a.cat3, a.cat2, a.cat1) as a, d.category as b
      from decoded d join ad_labels a on a.id = d.id where d.category <> 0) p""",
    "category_cost_tree": """
select p.a, p.b, case when p.a = p.b then 0 else (
         select cast(min_by(u.hops + 2 * q.p, u.hops) as int)
         from (select id as a, anc, hops as p from closure union all select id, 0, depth from depth) q
         join up u on q.anc = u.anc where q.a = p.a and u.b = p.b) end as cost
from (select distinct coalesce(a.cat3, a.cat2, a.cat1) as a, d.category as b
      from decoded d join ad_labels a on a.id = d.id where d.category <> 0) p""",
    "category_cost_tour": """
with pairs as (select distinct coalesce(a.cat3, a.cat2, a.cat1) as a, d.category as b
               from decoded d join ad_labels a on a.id = d.id where d.category <> 0)
select p.a, p.b,
       (select cast(min_by(u.hops + 2 * q.p, u.hops) as int) from pos q join up u on q.anc = u.anc
        where q.a = p.a and u.b = p.b) as cost,
       (select cast(min_by(u.hops + 2 * q.p, u.hops) as int)
        from (select id as a, anc, hops as p from closure union all select id, 0, depth from depth) q
        join up u on q.anc = u.anc where q.a = p.a and u.b = p.b) as tree_cost
from pairs p""",
    "category_frequency": """
select c.id, round(coalesce(f.n, 0) / (select count(*) from ad_labels), 9) as freq
from category c left join (
  select cl.anc as id, count(*) as n from ad_labels a
  join closure cl on cl.id = coalesce(a.cat3, a.cat2, a.cat1) group by cl.anc) f on f.id = c.id""",
    "category_weights": """
select c.id, round(coalesce(f.n, 0) / (select count(*) from ad_labels)
                   * (select count(*) from category) / s.row_sum, 9) as weight
from category c
left join (select cl.anc as id, count(*) as n from ad_labels a
           join closure cl on cl.id = coalesce(a.cat3, a.cat2, a.cat1) group by cl.anc) f on f.id = c.id
join (select a, sum(cost) as row_sum from (
        select q.a, u.b, min_by(u.hops + 2 * q.p, u.hops) as cost from pos q join up u on q.anc = u.anc
        where q.a <> u.b group by q.a, u.b) x group by a) s on s.a = c.id""",
    "category_weights_tour": """
select c.id, round(coalesce(f.n, 0) / (select count(*) from ad_labels), 9) as freq, cast(s.row_sum as bigint) as row_sum,
       round(coalesce(f.n, 0) / (select count(*) from ad_labels) * (select count(*) from category) / s.row_sum, 9) as weight
from category c
left join (select cl.anc as id, count(*) as n from ad_labels a
           join closure cl on cl.id = coalesce(a.cat3, a.cat2, a.cat1) group by cl.anc) f on f.id = c.id
join (select a, sum(cost) as row_sum from (
        select q.a, u.b, min_by(u.hops + 2 * q.p, u.hops) as cost from pos q join up u on q.anc = u.anc
        where q.a <> u.b group by q.a, u.b) x group by a) s on s.a = c.id""",
    "mean_hier_cost": """
select count(*) as n, cast(0 as bigint) as n_unknown, cast(coalesce(sum(k.cost), 0) as bigint) as total_cost,
       round(coalesce(sum(k.cost), 0) / count(*), 9) as mean_cost
from root_pred r left join (
  select q.a, u.b, min_by(u.hops + 2 * q.p, u.hops) as cost from pos q join up u on q.anc = u.anc
  where q.a <> u.b group by q.a, u.b) k on k.a = r.cat1 and k.b = r.category""",
    "mean_hier_cost_unknown": """
select count(*) as n, cast(count(*) filter (where id % 3 = 0) as bigint) as n_unknown,
       cast(coalesce(sum(k.cost) filter (where id % 3 <> 0), 0) as bigint) as total_cost,
       round(coalesce(sum(k.cost) filter (where id % 3 <> 0), 0) / count(*) filter (where id % 3 <> 0), 9) as mean_cost
from root_pred r left join (
  select q.a, u.b, min_by(u.hops + 2 * q.p, u.hops) as cost from pos q join up u on q.anc = u.anc
  where q.a <> u.b group by q.a, u.b) k on k.a = r.cat1 and k.b = r.category""",
    "selective_accuracy": """
select cast(n_correct as bigint) as n_correct, cast(n_resolved as bigint) as n_resolved,
       round(n_correct / n_resolved, 9) as selective_accuracy from selective""",
    "selective_accuracy_local_index": """
select cast(sum(case when d.depth <> 0 and x.idx = case d.depth when 1 then e.l1_idx when 2 then e.l2_idx
                     when 3 then e.l3_idx end then 1 else 0 end) as bigint) as n_correct,
       cast(sum(case when d.depth <> 0 then 1 else 0 end) as bigint) as n_resolved,
       round(sum(case when d.depth <> 0 and x.idx = case d.depth when 1 then e.l1_idx when 2 then e.l2_idx
                      when 3 then e.l3_idx end then 1 else 0 end)
             / sum(case when d.depth <> 0 then 1 else 0 end), 9) as selective_accuracy
from decoded d join encoded e on e.id = d.id left join category_index x on x.id = d.category""",
    "accuracy": """
select count(*) as n, cast(sum(case when l1_idx = idx then 1 else 0 end) as bigint) as n_correct,
       round(sum(case when l1_idx = idx then 1 else 0 end) / count(*), 9) as accuracy from root_pred""",
    "multiclass_metrics": """
with conf as (select cast(l1_idx as double) as label, cast(idx as double) as prediction, count(*) as n
              from root_pred group by 1, 2),
per as (
  select c, n_label, tp, coalesce(fp, 0) as fp, sum(n_label) over () as total from (
    select label as c, sum(n) as n_label, sum(case when label = prediction then n else 0 end) as tp
    from conf group by label) l
  left join (select prediction as pc, sum(case when label <> prediction then n else 0 end) as fp
             from conf group by prediction) p on p.pc = l.c),
m as (
  select *, case when tp + fp = 0 then 0.0 else tp / (tp + fp) end as precision, tp / n_label as recall,
         case when total - n_label = 0 then null else fp / (total - n_label) end as fpr from per)
select round(sum(tp) / max(total), 9) as accuracy,
       round(sum(case when precision + recall = 0 then 0.0
                      else 2 * precision * recall / (precision + recall) end * n_label / total), 9)
         as weighted_f_measure,
       round(sum(precision * n_label / total), 9) as weighted_precision,
       round(sum(recall * n_label / total), 9) as weighted_recall,
       round(sum(recall * n_label / total), 9) as weighted_true_positive_rate,
       round(sum(fpr * n_label / total), 9) as weighted_false_positive_rate
from m""",
    # training: the structure of the fitted hierarchy (weights themselves are
    # checked by accuracy in the tests)
    "train_lr": "select count(*) as n, true as beats_majority, true as pivot_agrees from encoded where l1_idx >= 0",
    "trained_cascade": f"""
select count(*) as n_items, count(*) as n_ids, true as valid_chain, true as beats_majority
from ad_labels where {H.format(x='cast(id as varchar)')} % 100 >= 60""",
    "fit_or_load": """
select (select count(*) from models) as n_nodes, cast(2 as int) as n_fits, (select count(*) from idf) as n_idf""",
    "mllib_models": """
select (select count(*) from docs) as n, true as same, cast(0 as int) as node,
       (select num_classes from child_counts where node = 0) as num_classes, cast(256 as int) as num_features""",
    "refit_changed_nodes": """
with one as (select * from ad_labels where id = (select min(id) from ad_labels where cat3 is not null))
select cast(1 as int) as step, node, cast(0 as bigint) as n_lost from models
union all select cast(3 as int), p.node, cast(0 as bigint)
from (select 0 as node union all select cat1 from one union all select cat2 from one) p
where p.node in (select node from models)""",
    "train_hierarchy": """
select node, level, num_classes, 30720 as num_features, num_classes >= 2 as has_weights from models""",
}


#: Keys whose SQL stands alone, without the shared prefix.
STANDALONE = {
    # the lexicon's rules applied to a word itself: 3 to 11 letters survive the tag filter
    "tfidf": """
with words as (select distinct doc_id as id, unnest(regexp_extract_all(text, '\\p{L}+')) as orth from documents),
terms as (
  select id, case when length(orth) = 10 then substr(orth, 1, 5)
                  when length(orth) > 4 and suffix(orth, 's') then substr(orth, 1, length(orth) - 1) else orth end as term
  from words where length(orth) between 3 and 11 and orth not in ('with', 'that', 'they', 'avec', 'pour', 'auch')
  union all select id, substr(orth, 6) from words where length(orth) in (10, 11)),
bag as (select distinct id, term from terms),
tf as (select id, cast(__H_TERM__ % 30720 as int) as bucket, count(*) as tf from bag group by 1, 2),
df as (select bucket, count(*) as df from tf group by bucket)
select t.id, t.bucket, t.tf, d.df, round(t.tf * ln((m.m + 1.0) / (d.df + 1.0)), 9) as value
from tf t join df d on d.bucket = t.bucket cross join (select count(*) as m from documents) m""",
}


def oracle_sql() -> dict[str, str]:
    out = {key: sql.strip().replace("__H_TERM__", H.format(x="term")) for key, sql in STANDALONE.items()}
    for key, sel in SELECTS.items():
        body = sel.strip().replace("__TAG_DROPPED__", TAG_DROPPED).replace("__H_TERM__", H.format(x="term"))
        if body.lower().startswith("with "):
            # a key-local WITH: splice its CTEs after the shared prefix
            body = body[5:]
            out[key] = PREFIX.rstrip() + ",\n" + body
        else:
            out[key] = PREFIX.rstrip() + "\n" + body
    return out
