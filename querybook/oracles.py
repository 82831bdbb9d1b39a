"""DuckDB SQL for every registered query, written from the business rules with plain joins and windows."""

import re

from querybook.fixtures import VIEWS, view_sql


def _r2(value: str) -> str:
    """Half-up to 2 places on the decimal text of a double, after settling at 9 places."""
    return f"cast(round(cast(cast({value} as varchar) as decimal(38,9)), 2) as double)"


_AGE_GROUP = """case when age is null then null when age < 25 then 'Jeune' when age <= 44 then 'Adulte'
    when age <= 64 then 'Âge Moyen' else 'Senior' end"""
_DAY_PERIOD = """case when td is null then null when hour(td) >= 6 and hour(td) < 12 then 'Morning'
    when hour(td) >= 12 and hour(td) < 18 then 'Afternoon' when hour(td) >= 18 and hour(td) < 22 then 'Evening'
    else 'Night' end"""
_BY_USER = "partition by user_id order by td nulls first, transaction_id"
_ALL_USER = "partition by user_id"
_LAST_7_DAYS = (
    "partition by user_id order by epoch_sec nulls first range between 604800 preceding and current row"
)


def _tagged(table: str, *rules: tuple[str, str]) -> str:
    labels = ", ".join(f"case when not coalesce({holds}, false) then '{label}' end" for holds, label in rules)
    return f"select *, concat_ws(' | ', {labels}) as rejection_reason from {table}"


_CTES = {
    **{name: view_sql(name, "duckdb") for name in VIEWS},
    "tagged_transactions": _tagged(
        "transactions", ("amount > 0", "amount <= 0"), ('length("timestamp") = 14', "timestamp_invalide")
    ),
    "tagged_users": _tagged(
        "users", ("age between 16 and 100", "age_hors_intervalle"), ("annual_income > 0", "income <= 0")
    ),
    "tagged_products": _tagged(
        "products", ("price > 0", "price <= 0"), ("rating between 1.0 and 5.0", "rating_hors_intervalle")
    ),
    "tagged_merchants": _tagged("merchants", ("commission_rate between 0.0 and 1.0", "commission_hors_intervalle")),
    **{
        f"ok_{name}": f"select * exclude (rejection_reason) from tagged_{name} where rejection_reason = ''"
        for name in ("transactions", "users", "products", "merchants")
    },
    "raw_dated": """select *, case when regexp_full_match("timestamp", '[0-9]{14}') and "timestamp" not like '0000%'
        then try_strptime("timestamp", '%Y%m%d%H%M%S') end as td from transactions""",
    "dated": """select *, case when regexp_full_match("timestamp", '[0-9]{14}') and "timestamp" not like '0000%'
        then try_strptime("timestamp", '%Y%m%d%H%M%S') end as td from ok_transactions""",
    "timed": f"""select *, cast(hour(td) as int) as hour, dayname(td) as day_of_week, monthname(td) as month,
        cast(case when td is null then null when isodow(td) >= 6 then 1 else 0 end as int) as is_weekend,
        {_DAY_PERIOD} as day_period,
        cast(case when td is null then null when hour(td) between 9 and 17 then 1 else 0 end as int)
          as is_working_hours,
        cast(epoch(td) as bigint) as epoch_sec from dated""",
    "joined": f"""select t.*, u.age, u.annual_income, u.city, u.customer_segment, {_AGE_GROUP} as age_group,
        p.name as product_name, p.price as product_price, p.rating, p.stock,
        m.name as merchant_name, m.category as merchant_category, m.region, m.commission_rate
        from timed t left join ok_users u on t.user_id = u.user_id
        left join ok_products p on t.product_id = p.product_id
        left join ok_merchants m on t.merchant_id = m.merchant_id""",
    "measured": f"""select *, row_number() over ({_BY_USER}) as transaction_rank,
        count(*) over ({_ALL_USER}) as total_transactions_user,
        sum(amount) over ({_LAST_7_DAYS}) as sum_7d,
        count(distinct cast(td as date)) over ({_LAST_7_DAYS}) as days_7d,
        cast(date_diff('day', cast(lag(td) over ({_BY_USER}) as date), cast(td as date)) as int)
          as jours_depuis_achat_precedent,
        avg(amount) over ({_ALL_USER}) as user_mean,
        (epoch_sec - lag(epoch_sec) over ({_BY_USER})) / 60.0::double as delay
        from joined""",
    "deviating": "select *, (amount - user_mean) / user_mean * 100 as deviation from measured",
    "flagged": """select *, case when deviation > 300 then 1 else 0 end::int as cond_montant,
        case when day_period = 'Night' then 1 else 0 end::int as cond_night,
        case when delay < 5 then 1 else 0 end::int as cond_delai,
        case when payment_method = 'CRYPTO' then 1 else 0 end::int as cond_crypto from deviating""",
    "scored": f"""select *, (cond_montant + cond_night + cond_delai + cond_crypto)::int as nb_conditions,
        case when cond_montant + cond_night + cond_delai + cond_crypto >= 2 then 1 else 0 end::int as is_suspicious,
        td as transaction_date, {_r2('sum_7d')} as montant_cumule_7j,
        case when days_7d >= 5 then 1 else 0 end::int as is_active_user,
        {_r2('user_mean')} as panier_moyen_user, {_r2('deviation')} as ecart_panier_moyen_pct,
        {_r2('delay')} as delai_precedente_minutes from flagged""",
    "merchant_base": f"""select merchant_id, merchant_name, merchant_category, region,
        {_r2('sum(amount)')} as chiffre_affaires, count(*) as nb_transactions,
        count(distinct user_id) as nb_clients_uniques, {_r2('avg(amount)')} as montant_moyen,
        {_r2('sum(amount * commission_rate)')} as commission_totale,
        {_r2("sum(case when age_group = 'Jeune' then amount else 0 end)")} as ca_jeune,
        {_r2("sum(case when age_group = 'Adulte' then amount else 0 end)")} as ca_adulte,
        {_r2("sum(case when age_group = 'Âge Moyen' then amount else 0 end)")} as ca_age_moyen,
        {_r2("sum(case when age_group = 'Senior' then amount else 0 end)")} as ca_senior,
        {_r2('avg(is_suspicious) * 100')} as taux_suspectes_pct
        from scored where merchant_name is not null group by all""",
    "merchant_ranked": """select *,
        cast(rank() over (partition by merchant_category order by chiffre_affaires desc) as int)
          as rang_ca_categorie,
        cast(rank() over (partition by region order by chiffre_affaires desc) as int) as rang_ca_region
        from merchant_base""",
    "long_dated": """select *, try_strptime("timestamp", '%Y%m%d%H%M%S') as td from transactions_long
        where amount > 0 and length("timestamp") = 14""",
    "attributable": "select * from long_dated where user_id is not null and td is not null",
    "firsts": """select user_id, min(td) as first_date, strftime(min(td), '%Y-%m') as cohort_month
        from attributable group by user_id""",
    "sizes": "select cohort_month, count(distinct user_id) as taille_cohorte from firsts group by cohort_month",
    "cells": f"""select cohort_month,
        cast(date_diff('month', date_trunc('month', first_date), date_trunc('month', td)) as int) as period_index,
        count(distinct a.user_id) as nb_utilisateurs_actifs, {_r2('sum(amount)')} as chiffre_affaires
        from attributable a join firsts f on a.user_id = f.user_id group by all""",
    "retention": f"""select cohort_month, period_index, taille_cohorte, nb_utilisateurs_actifs,
        {_r2('nb_utilisateurs_actifs / taille_cohorte * 100')} as taux_retention, chiffre_affaires,
        {_r2('chiffre_affaires / nb_utilisateurs_actifs')} as revenu_moyen_par_utilisateur
        from cells join sizes using (cohort_month)""",
    "product_totals": f"""select product_id, min(product_name) as product_name, min(category) as category,
        {_r2('sum(amount)')} as chiffre_affaires, count(*) as nb_transactions, min(rating) as rating,
        min(stock) as stock from joined where product_name is not null group by product_id""",
    "region_cells": f"""select region, category, {_r2('sum(amount)')} as chiffre_affaires,
        count(*) as nb_transactions from joined where region is not null and category is not null group by all""",
    "payment_cells": f"""select payment_method, day_period, {_r2('sum(amount)')} as chiffre_affaires,
        count(*) as nb_transactions from timed
        where payment_method is not null and day_period is not null group by all""",
}


def _sql(body: str) -> str:
    """``body`` preceded by the definitions it needs, in order."""
    needed: set[str] = set()
    todo = [body]
    while todo:
        words = set(re.findall(r"\w+", todo.pop()))
        for name in (words & _CTES.keys()) - needed:
            needed.add(name)
            todo.append(_CTES[name])
    definitions = ",\n".join(f"{name} as ({sql})" for name, sql in _CTES.items() if name in needed)
    return f"with {definitions}\n{body}"


def _flat_users(source: str, *, extra: str = "") -> str:
    return f"""select user_id, age, annual_income, city, customer_segment,
        coalesce(array_to_string(preferred_categories, ','), '') as preferred_categories, registration_date{extra}
        from {source}"""


def _nulls(table: str, columns: str) -> str:
    cells = " + ".join(f"(case when {c} is null then 1 else 0 end)" for c in columns.split())
    return f"coalesce((select sum({cells}) from {table}), 0)::bigint"


_COLUMNS = {
    "transactions": 'transaction_id user_id product_id merchant_id amount "timestamp" location payment_method category',
    "users": "user_id age annual_income city customer_segment preferred_categories registration_date",
    "products": "product_id name category price merchant_id rating stock",
    "merchants": "merchant_id name category region commission_rate establishment_date",
}


def _orphans(table: str, key: str) -> str:
    return f"""(select count(*) from transactions t where t.{key} is not null
        and not exists (select 1 from {table} r where r.{key} = t.{key}))"""


def _report_row(table: str) -> str:
    checked = {"users": "user_id", "products": "product_id", "merchants": "merchant_id"}
    orphans = ", ".join(
        f"{_orphans(name, key) if table == 'transactions' else '0::bigint'} as nb_{key}_orphelins"
        for name, key in checked.items()
    )
    rejected = "count(*) filter (where rejection_reason <> '')"
    return f"""select '{table}' as dataset, count(*) as nb_lignes_lues,
        count(*) filter (where rejection_reason = '') as nb_lignes_valides, {rejected} as nb_lignes_rejetees,
        case when count(*) = 0 then 0.0::double else {_r2(f"{rejected} * 100 / count(*)")} end as taux_rejet,
        {_nulls(table, _COLUMNS[table])} as nb_valeurs_nulles, {orphans} from tagged_{table}"""


def _union(template: str, tables: tuple[str, ...] = tuple(_COLUMNS)) -> str:
    return " union all ".join(template.format(table=table) for table in tables)


def _plain(table: str) -> str:
    return _COLUMNS[table].replace(" ", ", ")


_REPORT = " union all ".join(_report_row(table) for table in _COLUMNS)
_REJECTED_USERS = _flat_users("tagged_users", extra=", rejection_reason") + " where rejection_reason <> ''"
_ENRICHED = """transaction_id, user_id, product_id, merchant_id, amount, "timestamp", transaction_date, location,
    payment_method, category, age, annual_income, city, customer_segment, age_group, product_name, product_price,
    rating, stock, merchant_name, merchant_category, region, commission_rate, hour, day_of_week, month, is_weekend,
    day_period, is_working_hours, transaction_rank, total_transactions_user, montant_cumule_7j, is_active_user,
    jours_depuis_achat_precedent, ecart_panier_moyen_pct, is_suspicious"""

_HISTORY = """transaction_rank, total_transactions_user, montant_cumule_7j, is_active_user,
    jours_depuis_achat_precedent, delai_precedente_minutes, panier_moyen_user"""

_BODIES = {
    "read_csv_transactions": f"select {_plain('transactions')} from transactions",
    "read_json_users": _flat_users(
        "users", extra=", cast(len(preferred_categories) as int) as nb_categories"
    ),
    "read_parquet_products": f"select {_plain('products')} from products",
    "read_csv_merchants": f"select {_plain('merchants')} from merchants",
    "valid_transactions": f"select {_plain('transactions')} from ok_transactions",
    "rejected_transactions": f"""select {_plain('transactions')}, rejection_reason from tagged_transactions
        where rejection_reason <> ''""",
    "valid_users": _flat_users("ok_users"),
    "rejected_users": _REJECTED_USERS,
    "valid_products": f"select {_plain('products')} from ok_products",
    "rejected_products": f"""select {_plain('products')}, rejection_reason from tagged_products
        where rejection_reason <> ''""",
    "valid_merchants": f"select {_plain('merchants')} from ok_merchants",
    "rejected_merchants": f"""select {_plain('merchants')}, rejection_reason from tagged_merchants
        where rejection_reason <> ''""",
    "reject_reason_counts": _union(
        "select '{table}' as dataset, rejection_reason, count(*) as nb_lignes from tagged_{table} group by all"
    ),
    "null_cells": " union all ".join(
        f"select '{table}' as dataset, {_nulls(table, columns)} as nb_valeurs_nulles"
        for table, columns in _COLUMNS.items()
    ),
    "orphans_user": f"select 'user_id' as key, {_orphans('users', 'user_id')} as nb_orphelins",
    "orphans_product": f"select 'product_id' as key, {_orphans('products', 'product_id')} as nb_orphelins",
    "orphans_merchant": f"select 'merchant_id' as key, {_orphans('merchants', 'merchant_id')} as nb_orphelins",
    "quality_report": _REPORT,
    "reject_rate": f"select dataset, taux_rejet from ({_REPORT})",
    "duplicate_keys": " union all ".join(
        f"""select '{table}' as dataset, count(*) as nb_cles_en_double from
            (select {key} from {table} where {key} is not null group by {key} having count(*) > 1)"""
        for table, key in (
            ("users", "user_id"),
            ("products", "product_id"),
            ("merchants", "merchant_id"),
            ("transactions", "user_id"),
        )
    ),
    "parse_timestamps": 'select transaction_id, "timestamp", td as transaction_date from raw_dated',
    "time_features": f"""select transaction_id, cast(hour(td) as int) as hour, dayname(td) as day_of_week,
        monthname(td) as month, cast(case when isodow(td) >= 6 then 1 when td is not null then 0 end as int)
        as is_weekend, {_DAY_PERIOD} as day_period,
        cast(case when hour(td) between 9 and 17 then 1 when td is not null then 0 end as int) as is_working_hours
        from raw_dated""",
    "age_groups": f"select user_id, age, {_AGE_GROUP} as age_group from users",
    "revenue_by_period": f"""select day_period, {_r2('sum(amount)')} as chiffre_affaires,
        count(*) as nb_transactions from timed where day_period is not null group by day_period""",
    "join_users": "select transaction_id, user_id, age, annual_income, city, customer_segment from joined",
    "join_products": "select transaction_id, product_id, product_name, product_price, rating, stock from joined",
    "join_merchants": """select transaction_id, merchant_id, merchant_name, merchant_category, region,
        commission_rate from joined""",
    "join_broadcast_parity": f"""select {_plain('transactions')}, age, annual_income, city, customer_segment,
        product_name, product_price, rating, stock, merchant_name, merchant_category, region, commission_rate
        from joined""",
    "transaction_rank": "select transaction_id, user_id, transaction_date, transaction_rank from scored",
    "user_totals": "select transaction_id, user_id, total_transactions_user from scored",
    "rolling_7d_amount": "select transaction_id, montant_cumule_7j from scored",
    "active_users": "select transaction_id, is_active_user from scored",
    "days_since_previous": "select transaction_id, jours_depuis_achat_precedent from scored",
    "purchase_delay": "select transaction_id, delai_precedente_minutes from scored",
    "basket_deviation": "select transaction_id, panier_moyen_user, ecart_panier_moyen_pct from scored",
    "suspicion_flags": """select transaction_id, cond_montant, cond_night, cond_delai, cond_crypto, nb_conditions,
        is_suspicious from scored""",
    "suspicious_transactions": """select transaction_id, user_id, merchant_id, transaction_date, amount,
        panier_moyen_user, ecart_panier_moyen_pct, day_period, delai_precedente_minutes, payment_method,
        cond_montant, cond_night, cond_delai, cond_crypto, nb_conditions, is_suspicious
        from scored where is_suspicious = 1""",
    **{name: f"select transaction_id, {_HISTORY} from scored" for name in ("history_by_day", "history_mixed", "history_two_loads", "history_by_layout")},
    "enriched_transactions": f"select {_ENRICHED} from scored",
    "enriched_two_loads": f"select {_ENRICHED} from scored",
    "enriched_by_layout": f"select {_ENRICHED} from scored",
    "pipeline_enriched": f"select {_ENRICHED} from scored",
    "pipeline_other_thresholds": f"select {_ENRICHED} from scored",
    "pipeline_report": _REPORT,
    **{
        name: """select merchant_id, merchant_name, merchant_category, region, chiffre_affaires,
        nb_transactions, nb_clients_uniques, montant_moyen, rang_ca_categorie, rang_ca_region, commission_totale,
        ca_jeune, ca_adulte, ca_age_moyen, ca_senior, taux_suspectes_pct from merchant_ranked"""
        for name in ("merchant_kpis", "merchant_kpis_by_sort", "merchant_kpis_two_loads", "pipeline_kpis")
    },
    "merchant_ranks": """select merchant_id, merchant_category, region, chiffre_affaires, rang_ca_categorie,
        rang_ca_region from merchant_ranked""",
    "revenue_by_age_group": f"""select region,
        {_r2("sum(case when age_group = 'Jeune' then amount else 0 end)")} as ca_jeune,
        {_r2("sum(case when age_group = 'Adulte' then amount else 0 end)")} as ca_adulte,
        {_r2("sum(case when age_group = 'Âge Moyen' then amount else 0 end)")} as ca_age_moyen,
        {_r2("sum(case when age_group = 'Senior' then amount else 0 end)")} as ca_senior
        from joined group by region""",
    "top10_products": """select cast(row_number() over (order by chiffre_affaires desc, product_id) as int) as rang,
        product_id, product_name, category, chiffre_affaires, nb_transactions, rating, stock
        from product_totals order by chiffre_affaires desc, product_id limit 10""",
    "revenue_by_category_region": f"""select region, category, chiffre_affaires, nb_transactions,
        {_r2('chiffre_affaires / sum(chiffre_affaires) over (partition by region) * 100')} as part_ca_region_pct
        from region_cells""",
    "revenue_by_payment_period": f"""select payment_method, day_period, chiffre_affaires, nb_transactions,
        {_r2('chiffre_affaires / (select sum(chiffre_affaires) from payment_cells) * 100')} as part_ca_pct
        from payment_cells""",
    "first_purchase": "select user_id, first_date, cohort_month from firsts",
    **{name: "select cohort_month, taille_cohorte from sizes" for name in ("cohort_sizes", "cohort_sizes_by_bitmap")},
    **{name: "select * from retention" for name in ("cohort_retention", "cohort_retention_two_loads")},
    "written_order": """select row_number() over (order by cohort_month, period_index) as line, cohort_month,
        period_index from retention""",
    "best_cohort_3m": """select cohort_month, taille_cohorte, nb_utilisateurs_actifs as nb_utilisateurs_actifs_m3,
        taux_retention as taux_retention_m3 from retention where period_index = 3
        order by taux_retention desc, cohort_month limit 1""",
    # text of zero length and null look the same in CSV and are read back as null
    "sink_roundtrip": f"""select * replace (nullif(preferred_categories, '') as preferred_categories),
            'csv' as format from ({_REJECTED_USERS})
        union all select *, 'parquet' as format from ({_REJECTED_USERS})""",
}

ORACLES = {name: _sql(body) for name, body in _BODIES.items()}

# The thresholds of that query in place of the default ones.
for _default, _other in (
    ("age between 16 and 100", "age between 21 and 60"),
    ("rating between 1.0 and 5.0", "rating between 2.0 and 4.5"),
    ("commission_rate between 0.0 and 1.0", "commission_rate between 0.0 and 0.5"),
    ("range between 604800 preceding", "range between 259200 preceding"),
    ("days_7d >= 5", "days_7d >= 2"),
    ("deviation > 300", "deviation > 150"),
    ("delay < 5 ", "delay < 600 "),
    ("cond_crypto >= 2", "cond_crypto >= 1"),
):
    assert _default in ORACLES["pipeline_other_thresholds"]
    ORACLES["pipeline_other_thresholds"] = ORACLES["pipeline_other_thresholds"].replace(_default, _other)
