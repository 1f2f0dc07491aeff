"""Faceted search over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillstream.functions import all_terms, any_term
from tillstream.operators import search
from tillstream.plans.catalog import query
from tillstream.plans.join_queries import SALES_DOC_SQL
from tillstream.sources import domain
from tillstream.sources.files import table

KEYWORD = "Widget cold"
REQUEST = search.Request(terms={"order_status": "F"}, match=("sku_name", KEYWORD))
HITS_SQL = f"""
select * from ({SALES_DOC_SQL})
where order_status = 'F' and list_has_all(string_split(sku_name, ' '), ['widget', 'cold'])
"""
DETAIL_COLUMNS = ["order_detail_id", "order_id", "user_id", "sku_id", "sku_name", "user_gender", "user_age", "dt"]


def found(spark, folder):
    return search.hits(domain.sale_documents(spark, folder), REQUEST)


@query("select o_orderkey, o_custkey from orders where o_orderstatus = 'F'")
def term_filter(spark, folder):
    return table(spark, folder, "orders").where(search.term_filter("o_orderstatus", "F")).select("o_orderkey", "o_custkey")


@query("select p_partkey, p_name from part where list_has_all(string_split(p_name, ' '), ['widget', 'cold'])")
def match_all_terms(spark, folder):
    return table(spark, folder, "part").where(all_terms(F.col("p_name"), KEYWORD)).select("p_partkey", "p_name")


@query("select p_partkey, p_name from part where list_has_any(string_split(p_name, ' '), ['widget', 'cold'])")
def match_any_term(spark, folder):
    return table(spark, folder, "part").where(any_term(F.col("p_name"), KEYWORD)).select("p_partkey", "p_name")


@query(r"""
select doc_id, lang from documents
where list_has_all(regexp_split_to_array(lower(text), '[^\p{L}\p{M}\p{N}]+'), ['the', 'of'])
""")
def match_text(spark, folder):
    return table(spark, folder, "documents").where(all_terms(F.col("text"), "the of")).select("doc_id", "lang")


@query(HITS_SQL)
def bool_query(spark, folder):
    return found(spark, folder).drop("create_time")


@query(f"select count(*) as total from ({HITS_SQL})")
def hit_total(spark, folder):
    return search.hit_total(found(spark, folder))


@query(f"select max(user_age) as max_age from ({HITS_SQL})")
def max_metric(spark, folder):
    return search.max_metric(found(spark, folder), "user_age", "max_age")


@query(f"select user_gender, count(*) as doc_count from ({HITS_SQL}) group by 1")
def terms_gender(spark, folder):
    return search.terms(found(spark, folder), "user_gender")


@query(f"select user_age, count(*) as doc_count from ({HITS_SQL}) group by 1")
def terms_age(spark, folder):
    return search.terms(found(spark, folder), "user_age")


@query(f"select sku_name, count(*) as doc_count from ({SALES_DOC_SQL}) group by 1 order by 2 desc, 1 limit 10")
def terms_top_n(spark, folder):
    return search.top_terms(domain.sale_documents(spark, folder), "sku_name")


def _pct(part: str, total: str) -> str:
    return f"case when {total} > 0 then (({part}) * 2000 + {total}) // ({total} * 2) / 10.0 end"


@query(f"""
select total, {_pct('male', 'total')} as male_pct, {_pct('total - male', 'total')} as female_pct, unknown from (
  select count(*) as total, count(*) filter (user_gender = 'BUILDING') as male,
         count(*) filter (user_gender is null) as unknown from ({HITS_SQL}))
""")
def gender_ratio(spark, folder):
    return search.gender_ratio(found(spark, folder), male=domain.MALE)


AGES_SQL = f"""
select count(*) as total, count(user_age) as known, count(*) filter (user_age < 20) as young,
       count(*) filter (user_age >= 30) as senior from ({HITS_SQL})
"""


@query(f"""
select total, known, {_pct('young', 'known')} as young_pct, {_pct('known - young - senior', 'known')} as middle_pct,
       {_pct('senior', 'known')} as senior_pct from ({AGES_SQL})
""")
def age_ratio(spark, folder):
    return search.age_ratio(found(spark, folder))


@query(f"select order_detail_id, sku_name, dt from ({HITS_SQL}) order by order_detail_id limit 20 offset 40")
def page_offset(spark, folder):
    hits = found(spark, folder).select("order_detail_id", "sku_name", "dt")
    return search.page(hits, [F.col("order_detail_id")], 3, 20)


@query("select o_orderkey, o_custkey, o_orderstatus from orders order by o_orderkey limit 2")
def page_sorted(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return search.page(rows, [F.col("o_orderkey")], 1, 2)


@query("select o_orderkey, o_custkey from orders order by o_custkey, o_orderkey limit 13 offset 37")
def page_adapter(spark, folder):
    # Grids ask by row offset and length, which need not fall on page bounds.
    rows = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return search.page_at_row(rows, [F.col("o_custkey"), F.col("o_orderkey")], 37, 13)


@query("""
select o_custkey, o_orderkey, o_orderstatus from orders where (o_custkey, o_orderkey) > (100, 500)
order by o_custkey, o_orderkey limit 25
""")
def page_after_row(spark, folder):
    rows = table(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    return search.page_after(rows, ["o_custkey", "o_orderkey"], (100, 500), 25)


@query(f"""
with h as ({HITS_SQL})
select 'user_gender' as facet, user_gender as value, count(*) as doc_count from h where user_gender is not null group by 2
union all
select 'user_age', cast(user_age as varchar), count(*) from h where user_age is not null group by 2
union all
select 'total', null, count(*) from h
""")
def faceted_search(spark, folder):
    return search.facets(found(spark, folder), ["user_gender", "user_age"])


DOCUMENT_SQL = f"""
with h as ({HITS_SQL}),
s as (select count(*) as total, count(user_age) as known, count(*) filter (user_gender = 'BUILDING') as male,
             count(*) filter (user_age < 20) as young, count(*) filter (user_age >= 30) as senior from h),
d as (select list({{{', '.join(f"'{c}': {c}" for c in DETAIL_COLUMNS)}}} order by order_detail_id) as detail
      from (select * from h order by order_detail_id limit 5 offset 5))
select to_json({{'total': total,
  'stat': [
    {{'title': '{search.GENDER_TITLE}', 'options': [
      {{'name': '{search.MALE_NAME}', 'value': cast({_pct('male', 'total')} as varchar)}},
      {{'name': '{search.FEMALE_NAME}', 'value': cast({_pct('total - male', 'total')} as varchar)}}]}},
    {{'title': '{search.AGE_TITLE}', 'options': [
      {{'name': '{search.YOUNG_NAME}', 'value': cast({_pct('young', 'known')} as varchar)}},
      {{'name': '{search.MIDDLE_NAME}', 'value': cast({_pct('known - young - senior', 'known')} as varchar)}},
      {{'name': '{search.SENIOR_NAME}', 'value': cast({_pct('senior', 'known')} as varchar)}}]}}],
  'detail': detail}})::varchar as document
from s, d
"""


@query(DOCUMENT_SQL)
def stat_document(spark, folder):
    hits = found(spark, folder).select(*DETAIL_COLUMNS)
    return search.stat_document(hits, [F.col("order_detail_id")], 2, 5, male=domain.MALE)
