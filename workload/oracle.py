"""Checking SQL for the registered queries, over the same given tables."""

from __future__ import annotations

from scrapeloom.functions import text

from .scrape_view import COLUMNS, LANDING_SQL


def _in(tokens) -> str:
    return "(" + ", ".join("'" + t.replace("'", "''") + "'" for t in tokens) + ")"


NULL_TOKENS = _in(text.NULL_TOKENS)
CSV_NA = _in(text.CSV_NA_TOKENS)
CITY_PLACEHOLDERS = _in(text.CITY_PLACEHOLDERS)
# The text columns of a listing.
TEXT_COLUMNS = (
    "scrape_date", "category", "company_name", "phone", "email", "website",
    "employee_count", "city", "country", "scraped_at", "source_url",
)


def _missing(c: str) -> str:
    return f"({c} is null or lower(trim({c})) in {NULL_TOKENS})"


def _tidy(c: str) -> str:
    return f"case when {_missing(c)} then null else trim({c}) end"


def _category(c: str) -> str:
    return f"""case when {_missing(c)} then null
        when trim({c}) in ('legal', 'LEGAL', 'Lgl', 'Legal') then 'Legal'
        when trim({c}) in ('ERP', 'HR', 'Medical', 'MSP Platform', 'LMS') then trim({c})
        else 'Unknown' end"""


def _digits(c: str) -> str:
    return (
        f"regexp_replace(regexp_replace(trim({c}), '(?i)\\s*(ext\\.?|x\\b|#)\\s*\\d+.*$', ''), '[^0-9]', '', 'g')"
    )


def _national(c: str) -> str:
    d = _digits(c)
    return f"""case when length({d}) = 11 and {d} like '1%' then substring({d}, 2)
        when {d} like '0%' then substring({d}, 2) else {d} end"""


def _phone(c: str) -> str:
    return f"case when not {_missing(c)} and length({_national(c)}) = 10 then {_national(c)} end"


def _phone_flag(c: str) -> str:
    return f"""case when {_missing(c)} then 'null' when {_phone(c)} is not null then 'ok'
        else 'invalid' end"""


def _email_flag(c: str) -> str:
    return f"""case when {_missing(c)} then 'null' when {c} like '%@%' and {c} like '%.%' then 'ok'
        else 'invalid' end"""


def _site_key(c: str) -> str:
    return f"regexp_replace(regexp_replace(lower({c}), '^https?://', ''), '^www\\.', '')"


def _host(c: str) -> str:
    return f"nullif(split_part(split_part({_site_key(f'trim({c})')}, '/', 1), ':', 1), '')"


def _name(c: str) -> str:
    return f"""coalesce(regexp_replace(regexp_replace(trim(lower({c})),
        '[^\\p{{L}}\\p{{N}}_\\s]', '', 'g'), '\\s+', ' ', 'g'), '')"""


_RAW = f"""select l.* replace (case when count(l.scrape_date) over (partition by l._source_file) = 0
    then l._file_date else l.scrape_date end as scrape_date) from landing l"""

_KEPT = """select * from raw where category is distinct from 'category'
    and company_name is distinct from 'company_name' and scrape_date is distinct from 'scrape_date'"""

_TIDY = "select * replace (" + ", ".join(f"{_tidy(c)} as {c}" for c in TEXT_COLUMNS) + ") from kept"

_CLEAN = f"""select * replace ({_category('category')} as category),
    {_phone('phone')} as phone_clean, {_phone_flag('phone')} as phone_clean_flag,
    lower(email) as email_clean, {_email_flag('email')} as email_clean_flag,
    lower(website) as website_clean from tidy"""

_KEYED = f"""select *, {_host('website_clean')} as host, {_name('company_name')} as normalised_name,
    case when phone_clean is not null then 1 when {_host('website_clean')} is not null then 2 else 3 end as tier,
    coalesce(phone_clean, {_host('website_clean')}, {_name('company_name')}) as tier_key from clean"""

_NAMES = """select tier, tier_key, company_name,
    row_number() over (partition by tier, tier_key order by count(*) desc, company_name) as place
    from keyed where company_name is not null group by tier, tier_key, company_name"""

_GROUPED = """select tier, tier_key, min(phone_clean) as canonical_phone,
    coalesce(string_agg(distinct category, '|' order by category), '') as categories,
    count(*) as n_raw_rows, min(scrape_date) as first_seen,
    count(distinct phone_clean) as unique_phones, count(distinct host) as unique_domains,
    count(distinct company_name) as unique_names from keyed group by tier, tier_key"""

_ENTITIES = """select row_number() over (order by g.tier, g.tier_key) as entity_id,
    n.company_name as canonical_name, g.* from grouped g
    left join names n on n.tier = g.tier and n.tier_key = g.tier_key and n.place = 1"""

_MAP = """select entity_id, canonical_name, canonical_phone, categories, n_raw_rows, first_seen
    from entities"""

_DIM_DATE = """select strftime(d, '%Y-%m-%d') as date_id, d as full_date, cast(strftime(d, '%Y') as bigint) as year,
    cast(strftime(d, '%m') as bigint) as month, cast(strftime(d, '%d') as bigint) as day,
    cast(isodow(d) % 7 as bigint) as day_of_week,
    strftime(d - cast(isodow(d) - 1 as int), '%Y-%m-%d') as week_start
    from (select unnest(list_distinct(list(scrape_date)))::date as d from clean)"""

_DIM_CATEGORY = """select row_number() over (order by category) as category_id, category as category_name
    from (select distinct category from clean where category is not null and category <> 'Unknown')"""

_CITY = f"case when trim(city) in {CITY_PLACEHOLDERS} then null else city end"

_DIM_LOCATION = f"""select distinct
    dense_rank() over (order by country nulls last, {_CITY} nulls last) as location_id, {_CITY} as city, country
    from clean where country is not null"""


def _lookup(key: str, value: str, table: str) -> str:
    return f"(select map_from_entries(list(({key}, {value}))) as known from {table} where {key} is not null)"


def _fact(company_key: str, own_key: str, companies: str, rows: str) -> str:
    """One line per dated row; what no lookup knows is -1, or null for a category."""
    place = "country || chr(31) || ifnull(city, chr(30))"
    return f"""select phone_clean, email_clean, website_clean, employee_count, scraped_at, _source_file,
    labels.known[category] as category_id, ifnull(firms.known[{own_key}], -1) as entity_id,
    ifnull(places.known[{place}], -1) as location_id, scrape_date as date_id
    from {rows}, {_lookup("category_name", "category_id", "dim_category")} labels,
    {_lookup(company_key, "entity_id", companies)} firms, {_lookup(place, "location_id", "dim_location")} places
    where scrape_date is not null"""


_CTES = {
    "landing": LANDING_SQL,
    "raw": _RAW,
    "kept": _KEPT,
    "tidy": _TIDY,
    "clean": _CLEAN,
    "keyed": _KEYED,
    "names": _NAMES,
    "grouped": _GROUPED,
    "entities": _ENTITIES,
    "entity_map": _MAP,
    "all_names": """select row_number() over (order by min(event_id)) as ord, normalised_name as name
        from keyed group by normalised_name""",
    "dim_date": _DIM_DATE,
    "dim_category": _DIM_CATEGORY,
    "dim_location": _DIM_LOCATION,
    "fact": _fact("canonical_phone", "phone_clean", "entity_map", "clean"),
    # one line per week, known category and phone, straight from the clean rows
    "weekly": """select week_start, category, count(phone_clean) as unique_phones from (
        select distinct strftime(date_trunc('week', scrape_date::date), '%Y-%m-%d') as week_start, category, phone_clean
        from clean where scrape_date is not null and category <> 'Unknown') group by all""",
}


# The walk over similar names: ratio by longest common blocks, then name by name. Starts from walk_names.
_SIMILAR = {
    "close_names": """select a.ord as later, b.ord as earlier, a.name as x, b.name as y
        from walk_names a join walk_names b on a.ord > b.ord
        and levenshtein(a.name, b.name) <= (length(a.name) + length(b.name)) // 10""",
    # longest common block of each span, the first of them, then the spans to both sides
    "spans(later, earlier, x, y, x0, x1, y0, y1, hit)": """
        select later, earlier, x, y, 1, length(x) + 1, 1, length(y) + 1, 0 from close_names
        union all
        select later, earlier, x, y,
            unnest([x0, i + k]), unnest([i, x1]), unnest([y0, j + k]), unnest([j, y1]), unnest([k, 0])
        from (select *, row_number() over (partition by later, earlier, x0, y0, x1, y1 order by k desc, i, j) as best
            from (select later, earlier, x, y, x0, x1, y0, y1, min(i) as i, min(j) as j, cast(count(*) as int) as k
                from (select *, i - row_number() over (partition by later, earlier, x0, y0, x1, y1, i - j order by i) as run
                    from (select *, unnest(range(y0, y1)) as j
                        from (select *, unnest(range(x0, x1)) as i from spans))
                    where x[i] = y[j])
                group by later, earlier, x, y, x0, x1, y0, y1, i - j, run))
        where best = 1""",
    "alike": """select later, earlier from spans group by later, earlier, x, y
        having 2 * sum(hit) >= 0.9 * (length(x) + length(y))""",
    "linked": """select ord, row_number() over (order by ord) as nth, earlier
        from (select later as ord, list(earlier) as earlier from alike group by later
            union all select earlier, []::bigint[] from alike where earlier not in (select later from alike) group by earlier)""",
    "steps(nth, leaders, ord, leader)": """
        select 0::bigint, []::bigint[], 0::bigint, 0::bigint
        union all
        select l.nth, case when found is null then list_append(leaders, l.ord) else leaders end, l.ord, coalesce(found, l.ord)
        from (select l.*, s.leaders, list_min(list_intersect(l.earlier, s.leaders)) as found
            from steps s join linked l on l.nth = s.nth + 1) l""",
    "led": """select n.ord, n.name, coalesce(s.leader, n.ord) as leader from walk_names n left join steps s using (ord)""",
}


def _chain(parts: dict[str, str], last: str, body: str) -> str:
    """``body`` over the named queries up to ``last``; those with column names recurse."""
    found = []
    for name, sql in parts.items():
        found.append(f"{name} as {'' if '(' in name else 'materialized '}({sql})")
        if name == last:
            break
    return "with recursive " + ",\n".join(found) + "\n" + body


def _upto(last: str, body: str, **instead: str) -> str:
    """``body`` over the stage queries up to ``last``, some of them replaced."""
    parts = []
    for name, sql in {**_CTES, **instead}.items():
        parts.append(f"{name} as materialized ({sql})")
        if name == last:
            break
    return "with " + ",\n".join(parts) + "\n" + body


def _similar(last: str, body: str) -> str:
    """The stage queries with companies of similar names: tier 3 goes by the leader's name."""
    parts: dict[str, str] = {}
    for name, sql in _CTES.items():
        if name != "keyed":
            parts[name] = sql
            continue
        parts["own_keys"] = sql
        parts["walk_names"] = """select row_number() over (order by min(event_id), tier_key) as ord, tier_key as name
            from own_keys where tier = 3 group by tier_key"""
        parts |= _SIMILAR
        parts["keyed"] = """select k.* replace (coalesce(w.name, k.tier_key) as tier_key)
            from own_keys k left join led on k.tier = 3 and led.name = k.tier_key
            left join walk_names w on w.ord = led.leader"""
    return _chain(parts, last, body)


def _share(cte: str, name: str, condition, columns) -> str:
    return " union all ".join(
        f"""select '{c}' as column_name, count(*) filter (where {condition(c)}) as {name},
        round(count(*) filter (where {condition(c)}) * 100.0 / count(*), 1) as pct from {cte}"""
        for c in columns
    )


# The columns of the blank profile.
_BLANK_COLUMNS = (
    "scrape_date", "category", "company_name", "phone", "email", "website",
    "employee_count", "city", "country", "source_url",
)
_RAW_COLUMNS = tuple(COLUMNS)

_PCT = "round((unique_phones - before) * 100.0 / nullif(before, 0), 2)"


def _stability(key: str) -> str:
    return f"""select {key} as company, count(distinct phone_clean) as unique_phones,
    min(scrape_date) as first_seen, max(scrape_date) as last_seen, count(*) as row_count
    from keyed where {key} is not null and {key} <> '' and phone_clean is not null
    group by {key} having count(distinct phone_clean) > 1"""


_ROLLING = """select scrape_date, row_count, round(mean, 2) as rolling_avg,
    coalesce(abs(row_count - mean) <= 0.2 * mean, true) as within_band
    from (select scrape_date, row_count,
        avg(row_count) over (order by scrape_date rows between 7 preceding and 1 preceding) as mean
        from (select strftime(day, '%Y-%m-%d') as scrape_date, count(c.scrape_date) as row_count
            from (select unnest(generate_series(min(scrape_date)::date, max(scrape_date)::date, interval 1 day)) as day
                from clean) left join clean c on c.scrape_date = strftime(day, '%Y-%m-%d') group by 1))"""

_SUMMARY = """select case tier when 1 then 'phone' when 2 then 'host' else 'name' end as tier,
    cast(sum(n_raw_rows) as bigint) as row_count, count(*) as entity_count,
    round(sum(n_raw_rows) / count(*), 1) as dedup_ratio from entities group by tier
    union all select 'total', cast(sum(n_raw_rows) as bigint), count(*),
    round(sum(n_raw_rows) / count(*), 1) from entities"""

# an entity is new on the first of its days and returns on all later ones
_Q2 = """select date_id as scrape_date, count_if(nth = 1) as new_entities, count_if(nth > 1) as returning_entities
    from (select date_id, row_number() over (partition by entity_id order by date_id) as nth
        from (select distinct date_id, entity_id from fact where entity_id > 0)) group by all"""

_Q1 = """select scrape_date, category, count(phone_clean) as unique_phones
    from (select distinct scrape_date, category, phone_clean from clean
        where scrape_date is not null and category <> 'Unknown') group by all"""

_Q3 = """select canonical_name as entity_name, categories, first_seen from entity_map
    where categories like '%|%'"""

_Q3_KNOWN = """select canonical_name as entity_name, categories, first_seen from entity_map
    where len(list_filter(string_split(categories, '|'), lambda x: x <> 'Unknown')) > 1"""

_FIRST_DAY = _KEYED + " where _file_date = '2024-01-01'"

_Q4 = f"""select unnest(map_keys(seen)) as domain, unnest(map_values(seen))::bigint as row_count
    from (select histogram({_site_key('website_clean')}) as seen from fact where website_clean is not null)
    order by row_count desc, domain limit 10"""

_CANONICAL = "('ERP', 'HR', 'LMS', 'Legal', 'MSP Platform', 'Medical')"

ORACLES: dict[str, str] = {
    "null_tokens": _upto(
        "landing",
        "select event_id, "
        + ", ".join(f"{_missing(c)} as {c}_missing" for c in ("category", "phone", "email", "city"))
        + " from landing",
    ),
    "drop_header_rows": _upto(
        "landing",
        """select event_id, category, company_name, scrape_date from landing
        where category is distinct from 'category' and company_name is distinct from 'company_name'
        and scrape_date is distinct from 'scrape_date'""",
    ),
    "trim_text": _upto(
        "landing",
        "select event_id, " + ", ".join(f"{_tidy(c)} as {c}" for c in TEXT_COLUMNS) + " from landing",
    ),
    "clean_category": _upto(
        "landing",
        f"select event_id, category as raw_category, {_category('category')} as category from landing",
    ),
    "clean_phone": _upto(
        "landing",
        f"""select event_id, phone, {_phone('phone')} as phone_clean,
        {_phone_flag('phone')} as phone_clean_flag from landing""",
    ),
    "clean_email": _upto(
        "landing",
        f"""select event_id, email, lower({_tidy('email')}) as email_clean,
        {_email_flag('email')} as email_clean_flag from landing""",
    ),
    "clean_website": _upto(
        "landing", f"select event_id, website, lower({_tidy('website')}) as website_clean from landing"
    ),
    "extract_host": f"select page_id, url, {_host('url')} as host from pages",
    "site_key": f"select page_id, url, {_site_key('url')} as domain from pages",
    "normalise_name": _upto(
        "landing", f"select event_id, {_name('company_name')} as normalised_name from landing"
    ),
    "normalise_document_text": f"select doc_id, md5({_name('text')}) as text_md5 from documents",
    "clean_scrape": _upto("clean", "select * from clean"),
    "cleaning_summary": _upto(
        "clean",
        " union all ".join(
            f"""select 'values' as section, '{c}' as column_name, {c} as value, count(*) as row_count
            from clean where {c} is not null group by {c}"""
            for c in ("category", "phone_clean_flag", "email_clean_flag")
        )
        + " union all "
        + " union all ".join(
            f"""select 'nulls', '{c}', null, count(*) filter (where {c} is null) from clean"""
            for c in ("phone_clean", "email_clean", "website_clean", "city", "employee_count")
        ),
    ),
    "category_change": _upto(
        "tidy",
        f"""select category as raw_category, {_category('category')} as category, count(*) as row_count
        from tidy group by 1, 2""",
    ),
    "phone_samples_ok": _upto(
        "clean",
        "select distinct phone, phone_clean from clean where phone_clean_flag = 'ok' order by phone limit 10",
    ),
    "phone_samples_invalid": _upto(
        "clean",
        "select distinct phone, phone_clean from clean where phone_clean_flag = 'invalid' order by phone limit 10",
    ),
    "table_size": _upto(
        "raw",
        f"select count(*) as total_rows, cast({len(_RAW_COLUMNS)} as bigint) as total_columns from raw",
    ),
    "describe_columns": _upto(
        "raw",
        " union all ".join(
            f"""select '{c}' as column_name, '{"bigint" if c == "event_id" else "string"}' as column_type,
            count({c}) as filled_rows from raw"""
            for c in _RAW_COLUMNS
        ),
    ),
    "rows_per_day": _upto("raw", "select scrape_date, count(*) as row_count from raw group by 1"),
    "category_share": _upto(
        "raw",
        """select category, count(*) as row_count,
        round(count(*) * 100.0 / sum(count(*)) over (), 1) as pct from raw group by category""",
    ),
    "distinct_phone_sample": _upto(
        "raw", "select distinct phone from raw where phone is not null order by phone limit 15"
    ),
    "distinct_employee_bands": _upto(
        "raw",
        "select distinct employee_count from raw where employee_count is not null order by 1 limit 20",
    ),
    "null_profile": _upto(
        "raw",
        "select * from (" + _share("raw", "nulls", lambda c: f"{c} is null", _RAW_COLUMNS) + ") where nulls > 0",
    ),
    "blank_profile": _upto(
        "raw", _share("raw", "blanks", lambda c: f"{c} is null or trim({c}) = ''", _BLANK_COLUMNS)
    ),
    "null_text_scan": _upto(
        "raw",
        _share(
            "raw", "null_texts", lambda c: f"{c} is not null and lower(trim({c})) in {NULL_TOKENS}", _BLANK_COLUMNS
        ),
    ),
    "top_countries": _upto(
        "raw",
        """select country, count(*) as row_count from raw where country is not null group by country
        order by row_count desc, country limit 10""",
    ),
    "schema_change_trace": _upto(
        "raw",
        """select scrape_date, count(*) as total_rows, count(source_url) as rows_with_source_url
        from raw group by scrape_date""",
    ),
    "late_column_rows": _upto(
        "raw", "select event_id, scrape_date, source_url from raw where source_url is not null"
    ),
    "preview_rows": _upto("raw", "select * from raw order by event_id limit 3"),
    "phone_digit_lengths": _upto(
        "raw",
        f"""select length({_digits('phone')}) as n_digits, substring({_digits('phone')}, 1, 1) as leading_digit,
        count(*) as row_count from raw where not {_missing('phone')} group by 1, 2""",
    ),
    "category_variants": _upto(
        "raw",
        f"""select category as raw_category, {_category('category')} as canonical,
        min(scrape_date) as first_seen, count(distinct _source_file) as n_files, count(*) as row_count
        from raw where category is not null group by 1, 2""",
    ),
    "malformed_emails": _upto(
        "clean",
        "select email_clean_flag, count(*) as row_count, min(scrape_date) as first_seen from clean group by 1",
    ),
    "rolling_volume_check": _upto("clean", _ROLLING),
    "phone_stability_by_host": _upto("keyed", _stability("host")),
    "phone_stability_by_name": _upto("keyed", _stability("normalised_name")),
    "file_date_from_name": _upto(
        "landing",
        """select event_id, _source_file,
        regexp_extract(_source_file, '^[^_]*_(.*)\\.csv$', 1) as file_date from landing""",
    ),
    "file_date_fallback": _upto("raw", "select event_id, scrape_date, _source_file from raw"),
    "union_by_name_drift": _upto(
        "landing",
        """select * exclude (source_url), case when _file_date >= '2024-01-15' then source_url end as source_url
        from landing""",
    ),
    "csv_round_trip_ingest": (
        "with landing as ("
        + "select event_id, "
        + ", ".join(f"case when {c} in {CSV_NA} then null else {c} end as {c}" for c in TEXT_COLUMNS)
        + f", _source_file, _file_date from ({LANDING_SQL})),\nraw as ({_RAW})\nselect * from raw"
    ),
    "csv_faulty_files_report": _upto(
        "landing",
        """select _source_file, case when _file_date like '%5' then 'failed' else 'ok' end as status,
        count(*) filter (where event_id % 50 <> 0 and _file_date not like '%5') as row_count,
        count(*) filter (where event_id % 50 = 0 and _file_date not like '%5') as malformed,
        case when _file_date like '%5' then 'broken stream' end as reason from landing group by _source_file, _file_date
        union all select 'scrape_2024-02-01.csv', 'empty', 0, 0, null
        union all select 'scrape_2024-02-02.csv', 'empty', 0, 0, null""",
    ),
    "csv_rows_of_whole_files": (
        "with landing as (select event_id, "
        + ", ".join(f"case when {c} in {CSV_NA} then null else {c} end as {c}" for c in TEXT_COLUMNS)
        + f", _source_file, _file_date from ({LANDING_SQL})),\nwhole as (select * replace ("
        + ", ".join(
            f"case when event_id % 50 = 1 then null else {c} end as {c}" for c in TEXT_COLUMNS[5:] if c != "source_url"
        )
        + f") from landing where event_id % 50 <> 0 and _file_date not like '%5'),\nraw as ({_RAW.replace('landing l', 'whole l')})"
        + "\nselect * exclude (source_url, _file_date) from raw"
    ),
    "csv_ingest_report": _upto(
        "landing",
        """select _source_file, _file_date, 'ok' as status, count(*) as row_count,
        cast(0 as bigint) as malformed from landing group by 1, 2""",
    ),
    "csv_schema_drift": _upto(
        "landing",
        """select distinct _source_file,
        case when _file_date < '2024-01-15' then 'event_id' else 'event_id|source_url' end as extra_columns,
        '' as missing_columns from landing""",
    ),
    "written_row_check": _upto(
        "clean",
        """select 'clean_scrape' as table_name, count(*) as rows_expected, count(*) as rows_written,
        true as matches from clean""",
    ),
    "published_run": _upto("clean", "select 'all' as run, count(*) as row_count, 1 as refused from clean"),
    "entity_ids_of_a_later_run": _upto(
        "keyed",
        """, early as (select distinct tier, tier_key from keyed where _file_date = '2024-01-01'),
        given as (select tier, tier_key as entity_key, row_number() over (order by tier, tier_key) as entity_id from early),
        fresh as (select distinct tier, tier_key from keyed except select tier, tier_key from early)
        select * from given union all
        select tier, tier_key, (select count(*) from given) + row_number() over (order by tier, tier_key) from fresh""",
    ),
    "entity_tiers": _upto("keyed", "select event_id, tier, tier_key from keyed"),
    "signal_counts": _upto(
        "keyed",
        """select 'phone' as signal, count(distinct phone_clean) as unique_values from keyed
        union all select 'host', count(distinct host) from keyed
        union all select 'company_name', count(distinct company_name) from keyed""",
    ),
    "entity_map": _upto("entity_map", "select * from entity_map"),
    "entity_map_singletons": _upto(
        "entity_map",
        "select * from entity_map",
        keyed="select * replace (case when tier = 3 and tier_key = '' then concat(chr(1), event_id) "
        f"else tier_key end as tier_key) from ({_KEYED})",
    ),
    "entity_conflicts": _upto(
        "entities",
        """select entity_id, canonical_name, unique_phones, unique_domains, unique_names, n_raw_rows
        from entities where unique_phones > 1 or unique_domains > 1 or unique_names > 1""",
    ),
    "resolution_summary": _upto("entities", _SUMMARY),
    "top_entities": _upto(
        "entities",
        """select entity_id, canonical_name, canonical_phone, categories, n_raw_rows from entities
        order by n_raw_rows desc, entity_id limit 10""",
    ),
    "entity_assignments": _upto(
        "entities",
        """select k.event_id, k.tier, e.entity_id from keyed k
        join entities e on e.tier = k.tier and e.tier_key = k.tier_key""",
    ),
    "fuzzy_name_clusters": _chain(
        {**{k: v for k, v in _CTES.items() if k != "entity_map"}, "walk_names": "select * from all_names", **_SIMILAR},
        "led",
        """select led.ord, led.name, led.leader, w.name as leader_name
        from led join walk_names w on w.ord = led.leader""",
    ),
    "entity_map_similar_names": _similar("entity_map", "select * from entity_map"),
    "resolution_summary_similar_names": _similar("entities", _SUMMARY),
    "fuzzy_name_pairs": _upto(
        "all_names",
        """select a.ord as later, b.ord as earlier, a.name as later_name, b.name as earlier_name
        from all_names a join all_names b on a.ord > b.ord
        and levenshtein(a.name, b.name) <= (length(a.name) + length(b.name)) // 10""",
    ),
    "dim_date": _upto(
        "dim_date", "select * replace (cast(full_date as string) as full_date) from dim_date"
    ),
    "dim_category": _upto("dim_category", "select * from dim_category"),
    "dim_entity": _upto(
        "entity_map", "select * exclude (categories), categories as all_categories from entity_map"
    ),
    "dim_location": _upto("dim_location", "select * from dim_location"),
    "dim_location_of_raw_cities": _upto(
        "raw",
        """select row_number() over (order by country nulls last, city nulls last) as location_id, city, country
        from (select distinct city, country from raw where country is not null)""",
    ),
    "fact_scrape": _upto("fact", "select * from fact"),
    "fact_scrape_by_assignment": _upto(
        "dim_location",
        _fact("tier || ' ' || tier_key", "tier || ' ' || tier_key", "entities", "keyed"),
    ),
    "model_row_counts": _upto(
        "fact",
        " union all ".join(
            f"select '{name}' as table_name, count(*) as row_count from {cte}"
            for name, cte in (
                ("dim_date", "dim_date"),
                ("dim_category", "dim_category"),
                ("dim_entity", "entity_map"),
                ("dim_location", "dim_location"),
                ("fact_scrape", "fact"),
            )
        ),
    ),
    "q1_daily_unique_phones": _upto("fact", _Q1),
    "q2_new_vs_returning": _upto("fact", _Q2),
    "q3_cross_category_entities": _upto("entity_map", _Q3),
    "q3_cross_category_known_labels": _upto("entity_map", _Q3_KNOWN),
    "q3_cross_category_of_the_first_day": _upto("entity_map", _Q3, keyed=_FIRST_DAY),
    "q3_known_labels_of_the_first_day": _upto("entity_map", _Q3_KNOWN, keyed=_FIRST_DAY),
    "q4_top_domains": _upto("fact", _Q4),
    "q5_weekly_change": _upto(
        "weekly",
        f"""select week_start, category, unique_phones, {_PCT} as pct_change from (
            select w.*, p.unique_phones as before from weekly w asof left join weekly p
            on w.category = p.category and w.week_start > p.week_start)""",
    ),
    "weekly_growth_total": _upto(
        "fact",
        f"""select week_start, unique_phones, {_PCT} as pct_change from (select *,
        lag(unique_phones) over (order by week_start) as before from (
            select dd.week_start, count(distinct f.phone_clean) as unique_phones from fact f
            join dim_date dd on f.date_id = dd.date_id group by 1))""",
    ),
    "pages_top_sites": f"""select {_site_key('url')} as domain, count(*) as row_count from pages
        where url is not null group by 1 order by row_count desc, domain limit 10""",
    "report_files": _upto(
        "weekly",
        " union all ".join(
            f"select '{name}' as report, count(*) as row_count from ({sql})"
            for name, sql in (
                ("q1_daily_unique_phones", _Q1),
                ("q2_new_vs_returning", _Q2),
                ("q3_cross_category_entities", _Q3),
                ("q4_top_domains", _Q4),
                ("q5_weekly_change", "select * from weekly"),
            )
        ),
    ),
    "dq_gates": _upto(
        "entity_map",
        f"""select check_name, failures, failures = 0 as passed from (
        select 'phone_not_null' as check_name, count(*) filter (where phone_clean is null) as failures from clean
        union all select 'category_canonical',
            count(*) filter (where category is null or category not in {_CANONICAL}) from clean
        union all select 'phone_ten_digits',
            count(*) filter (where not regexp_matches(phone_clean, '^[0-9]{{10}}$')) from clean
        union all select 'entity_id_unique', count(*) - count(distinct entity_id) from entity_map
        union all select 'daily_volume_in_band', count(*) filter (where not within_band) from ({_ROLLING}))""",
    ),
    "dq_violations_of_spoilt_rows": _upto(
        "clean",
        f"""select event_id, 'phone_ten_digits' as check_name from clean where event_id % 7 = 0 and phone_clean is not null
        union all select event_id, 'category_canonical' from clean where category is null or category not in {_CANONICAL}
            or event_id % 13 = 0
        union all select event_id, 'bad_date' from clean where event_id % 11 = 0""",
    ),
    "dq_entities_written_twice": _upto(
        "entities", "select entity_id, cast(2 as bigint) as row_count from entities where tier < 3"
    ),
    "fact_ids": _upto("fact", "select count(*) as row_count, count(*) as fact_ids from fact"),
    "dq_phone_not_null": _upto("clean", "select event_id, phone from clean where phone_clean is null"),
    "dq_category_canonical": _upto(
        "clean",
        f"select event_id, category from clean where category is null or category not in {_CANONICAL}",
    ),
    "dq_duplicate_entities": _upto(
        "entity_map",
        "select entity_id, count(*) as row_count from entity_map group by 1 having count(*) > 1",
    ),
    "dq_phone_ten_digits": _upto(
        "clean",
        """select event_id, phone_clean from clean
        where phone_clean is not null and not regexp_matches(phone_clean, '^[0-9]{10}$')""",
    ),
    "dq_bad_dates": _upto(
        "clean",
        """select event_id, scrape_date from clean
        where scrape_date is not null and try_cast(scrape_date as date) is null""",
    ),
    "days_replaced": _upto(
        "clean",
        """select day, case when day in (lo, hi) then 2 else 1 end::bigint as load, kept as rows_expected, kept as rows_found,
            true as matches, case when kept > 0 then id_sum end as id_sum
        from (select day, lo, hi, count(event_id) as kept, cast(sum(event_id) as bigint) as id_sum
            from (select scrape_date as day, lo, hi,
                    case when scrape_date = lo or (scrape_date = hi and event_id % 2 = 1) then null else event_id end as event_id
                from clean, (select min(scrape_date) as lo, max(scrape_date) as hi from clean)) group by all)""",
    ),
    "q2_of_new_days": _upto(
        "fact",
        f"select * from ({_Q2}) where scrape_date in (select date_id from dim_date order by date_id limit 3 offset 1)",
    ),
    "weekly_phones_by_sketch": _upto("weekly", "select week_start, category, unique_phones, true as within_error from weekly"),
}
