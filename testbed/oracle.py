"""The registered queries as DuckDB SQL over the same tables."""

from __future__ import annotations

from siltstone import rules

ORACLE: dict[str, str] = {}


def like_any(text: str, terms) -> str:
    return "(" + " or ".join(f"{text} like '%{t}%'" for t in terms) + ")"


def ladder(text: str, ladder_rules, default: str) -> str:
    whens = " ".join(f"when {like_any(text, terms)} then '{label}'" for label, terms in ladder_rules)
    return f"case {whens} else '{default}' end"


PART_TYPE = [("widget", ["widget"]), ("fastener", ["bolt", "rod"]), ("ring", ["ring"])]
PART_LEVEL = [
    ("direct_competitor", ["red ", "blue "]),
    ("existing_competitor", ["large"]),
    ("indirect_competitor", ["small", "new bolt"]),
]

# --- activity ----------------------------------------------------------------

FEATURES = """
features as (
    select 'nation/' || c_nationkey as repository, o_orderdate as closed_at
    from orders join customer on o_custkey = c_custkey
    where case when lower(o_orderpriority) like '%urgent%' then 'bug fix'
               when lower(o_orderpriority) like '%high%' or lower(o_orderpriority) like '%medium%'
                 or lower(o_orderpriority) like '%low%' then 'feature'
               else 'not clear' end = 'feature'
)"""

RAW_PULLS = """
raw_pulls as (
    select event_id as id, event_id as number,
        case when hour(ts) < 4 then 'Fix ' when hour(ts) < 10 then 'Add '
             when hour(ts) < 14 then 'Refactor ' when hour(ts) < 18 then 'Test '
             when hour(ts) < 20 then 'Update docs ' else 'Note ' end || props as title,
        props as body, case when value < 10 then 'open' else 'closed' end as state,
        'u' || user_id as login, 'main' as base_ref, 'b' || event_id as head_ref,
        strftime(ts, '%Y-%m-%dT%H:%M:%SZ') as made_at,
        case when value < 10 then null else strftime(ts, '%Y-%m-%dT%H:%M:%SZ') end as closed_at,
        'org/' || event_type as repository
    from events
)"""
PULL_CLASS = ladder("lower(title)", rules.PR_TITLE_RULES, rules.PR_TITLE_DEFAULT)

STAGED_RELEASES = """
staged_releases as (
    select * from (
        select *, row_number() over (
            partition by repository, tag
            order by published_at desc, id desc) as row_num
        from (
            select 'supplier/' || l_suppkey as repository,
                l_orderkey * 10 + l_linenumber as id,
                'Line ' || l_orderkey as release_name,
                'v' || l_partkey || '.' || l_linenumber as tag,
                l_returnflag as release_author,
                strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ') as published_at,
                strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ') as created_at,
                strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ') as updated_at,
                cast(null as varchar) as release_url, cast(null as varchar) as body,
                l_linestatus = 'O' as is_draft, l_returnflag = 'R' as is_prerelease,
                '2024-01-31T00:00:00' as fetched_at
            from lineitem where l_tax > 0
        )
    ) where row_num = 1
),
release_times as (
    select repository, cast(left(published_at, 19) as timestamp) as published_at from staged_releases
)"""


def monthly(events: str, key: str, ts: str, month: str, count: str) -> str:
    return f"""select {key}, cast(date_trunc('month', {ts}) as timestamp) as {month},
        count(*) as {count} from {events} group by 1, 2"""


def vs_top(events: str, key: str, pinned: str, n: int, label: str = "pinned") -> str:
    """The top keys and the selected rows with their group."""
    return f"""
top_keys as (
    select {key} from {events} group by 1 order by count(*) desc, {key} limit {n}
),
selected as (
    select *, case when {key} = {pinned} then '{label}' else 'top_10' end as repo_group
    from {events} where {key} = {pinned} or {key} in (select {key} from top_keys)
)"""


def median_gap(key: str, ts: str, digits: int, out: str, group: bool = False) -> str:
    extra = ", any_value(repo_group) as repo_group" if group else ""
    return f"""
gaps as (
    select *, (epoch_us({ts}) - epoch_us(prev)) / 86400e6 as gap
    from (select *, lag({ts}) over (partition by {key} order by {ts} nulls last) as prev from selected)
    where prev is not null
)
select {key}, round(quantile_cont(gap, 0.5), {digits}) as {out}{extra} from gaps group by {key}"""


ORACLE["activity_monthly"] = f"""with {FEATURES}
{monthly('features', 'repository', 'closed_at', 'month', 'feature_pr_count')}
order by repository, month"""

ORACLE["pinned_vs_top_monthly"] = f"""with {FEATURES}, {vs_top('features', 'repository', "'nation/7'", 10)}
select repository, repo_group, cast(date_trunc('month', closed_at) as timestamp) as pr_month,
    count(*) as feature_pr_count
from selected group by 1, 2, 3 order by 3, 1"""

ORACLE["median_gap_vs_top"] = f"""with {vs_top('events', 'user_id', '7', 10)},
{median_gap('user_id', 'ts', 2, 'median_days')}"""

ORACLE["median_gap_vs_top_sliced"] = f"""with {vs_top('events', 'event_type', "'error'", 3)},
{median_gap('event_type', 'ts', 6, 'median_days', True)}"""

ORACLE["staged_pull_requests"] = f"""with {RAW_PULLS}
select repository, id, number, title, body as description, state, login as author,
    base_ref as base_branch, head_ref as head_branch, cast(null as varchar) as url,
    made_at as created_at, closed_at, cast(null as varchar) as merged_at,
    '2024-01-31T00:00:00' as fetched_at, {PULL_CLASS} as feat_classifier
from raw_pulls"""

ORACLE["features_from_staged"] = f"""with {RAW_PULLS},
closed as (
    select repository, cast(left(closed_at, 19) as timestamp) as closed_at
    from raw_pulls where {PULL_CLASS} = 'feature'
)
{monthly('closed', 'repository', 'closed_at', 'month', 'feature_pr_count')}"""

ORACLE["staged_releases"] = f"with {STAGED_RELEASES} select * from staged_releases"

ORACLE["releases_monthly"] = f"""with {STAGED_RELEASES}
{monthly('release_times', 'repository', 'published_at', 'release_month', 'release_count')}"""

ORACLE["releases_vs_top_monthly"] = f"""with {STAGED_RELEASES},
{vs_top('release_times', 'repository', "'supplier/3'", 10)}
select repository, repo_group, cast(date_trunc('month', published_at) as timestamp) as release_month,
    count(*) as release_count
from selected group by 1, 2, 3"""

ORACLE["median_gap_releases"] = f"""with {STAGED_RELEASES},
{vs_top('release_times', 'repository', "'supplier/3'", 10)},
{median_gap('repository', 'published_at', 2, 'median_days_between_releases')}"""

ORACLE["positional_group_by"] = """select event_type,
    cast(date_trunc('month', ts) as timestamp) as month, count(*) as n, max(value) as highest
from events group by 1, 2 order by 2, 1"""

# --- windows and quantiles ---------------------------------------------------

LINE_ORDER = """l_shipdate desc, l_partkey desc, l_suppkey desc, l_quantity desc,
    l_extendedprice desc, l_discount desc, l_tax desc, l_returnflag desc, l_linestatus desc,
    l_orderkey desc"""
LATEST_LINES = f"""select * exclude (n) from (
    select *, row_number() over (
        partition by l_orderkey, l_linenumber order by {LINE_ORDER}) as n
    from lineitem
) where n = 1"""
for _name in ("latest_per_key", "upsert_latest", "merge_into_latest", "bucketed_merge"):
    ORACLE[_name] = LATEST_LINES

ORACLE["previous_event"] = """select event_id, event_type, ts,
    lag(ts) over (partition by event_type order by ts) as prev_date from events"""

ORACLE["previous_event_even"] = ORACLE["previous_event"]

ORACLE["places_among_ties"] = """select l_returnflag, l_linestatus, l_orderkey, l_linenumber,
    row_number() over (partition by l_returnflag order by l_linestatus desc nulls last, l_orderkey, l_linenumber) - 1 as place
from lineitem"""

ORACLE["event_gaps"] = """select event_id, user_id, ts, (epoch_us(ts) - epoch_us(prev)) / 86400e6 as days_diff
from (select *, lag(ts) over (partition by user_id order by ts) as prev from events)
where prev is not null"""

ORACLE["gap_counts"] = """with prs as (
    select 'nation/' || c_nationkey as repository, o_orderdate as closed_at
    from orders join customer on o_custkey = c_custkey
),
gaps as (
    select repository, (epoch_us(closed_at) - epoch_us(
        lag(closed_at) over (partition by repository order by closed_at))) / 86400e6 as days_diff
    from prs
)
select repository, days_diff, count(*) as gaps from gaps
where days_diff is not null group by 1, 2"""

ORACLE["previous_event_sliced"] = ORACLE["previous_event"]
ORACLE["gap_counts_sliced"] = ORACLE["gap_counts"]

QUANTILE = """select l_returnflag, l_linestatus,
    round(quantile_cont(cast(round(l_extendedprice * 100) as bigint), 0.9), 4) as p90
from lineitem group by 1, 2"""
ORACLE["quantile_by_key"] = QUANTILE
ORACLE["quantile_by_key_sliced"] = QUANTILE
ORACLE["quantile_by_key_even"] = QUANTILE

# --- rules and text ----------------------------------------------------------

ORACLE["label_ladder_parts"] = f"""with p as (
    select p_partkey, p_name, lower(p_name || ' ' || coalesce(p_type, '')) as t from part
)
select p_partkey, p_name, {ladder('t', PART_TYPE, 'other')} as part_type,
    {ladder('t', PART_LEVEL, 'other')} as part_level,
    case when regexp_matches(t, '\\brod\\b') then 'rod'
         when regexp_matches(t, '\\bpro\\b') then 'promo' else 'none' end as whole_word
from p"""

ORACLE["label_ladder_docs"] = f"""with d as (select doc_id, lower(text) as t from documents)
select doc_id,
    {ladder('t', rules.PR_TITLE_RULES, rules.PR_TITLE_DEFAULT)} as title_class,
    {ladder('t', rules.PR_TITLE_SHORT_RULES, rules.PR_TITLE_SHORT_DEFAULT)} as short_class,
    {ladder('t', rules.PR_TITLE_TEST_FIRST_RULES, rules.PR_TITLE_DEFAULT)} as test_first_class,
    {ladder('t', rules.WALLET_TYPE_RULES, rules.WALLET_TYPE_DEFAULT)} as wallet_type,
    {ladder('t', rules.COMPETITION_RULES, rules.COMPETITION_DEFAULT)} as competition_level
from d"""

ORACLE["text_flags"] = f"""with d as (
    select documents.*, case when quality = 1 then source end as note
    from documents left join labels using (doc_id)
),
t as (
    select *, lower(note || ' ' || coalesce(text, '') || ' ' || coalesce(lang, '')) as noted_text,
        lower(text || ' ' || coalesce(note, '')) as plain
    from d
)
select doc_id,
    case when {like_any('noted_text', ['src1', 'heon', 'de'])} then true else false end as noted,
    case when {like_any('plain', rules.WALLET_TERMS)} then true else false end as is_wallet_related,
    case when {like_any('plain', rules.COMPETITOR_TERMS)} then true else false end
        as potential_competitor,
    case when note like '%src7%' or lang like '%src7%' or text like '%src7%'
        then true else false end as mentions_src7
from t"""

ORACLE["bracket_tokens"] = """with o as (
    select o_orderkey, string_split(replace(replace(
        '[' || o_orderstatus || ', ' || o_orderpriority || ']', '[', ''), ']', ''), ',') as tokens
    from orders
)
select o_orderkey, list_contains(tokens, 'F') as first_found,
    list_contains(tokens, '1-URGENT') as second_found,
    list_contains(list_transform(tokens, lambda x: trim(x)), '1-URGENT') as second_trimmed
from o"""

ORACLE["link_parts"] = """with k as (
    select page_id, url, html, case when url like '%example.%'
        then lower(regexp_extract(url, '://([^/]+/[^/]+)', 1)) end as full_name
    from pages
)
select page_id, full_name, split_part(full_name, '/', 1) as owner,
    split_part(full_name, '/', 2) as name,
    coalesce(url like '%spam-farm%', false) or coalesce(html like '%spam-farm%', false)
        as has_spam_uri
from k"""

# --- proposals ---------------------------------------------------------------

ORACLE["staged_funds"] = """select cast(n_nationkey as bigint) as id, n_name as title,
    cast(n_nationkey as bigint) as fund_number, cast(n_regionkey * 1000 as bigint) as funding_available,
    lower(n_name) as slug, cast(null as varchar) as description,
    timestamp '2024-01-31 00:00:00' as _loaded_at, 'governance_api' as _source
from nation"""

ENRICHED = f"""
lines as (
    select l_orderkey,
        count(*) filter (where l_returnflag = 'R') as yes_votes,
        count(*) filter (where l_returnflag = 'A') as no_votes,
        count(*) filter (where l_returnflag = 'N') as abstain_votes,
        min(l_partkey) as first_part, count(distinct l_linenumber) as links
    from lineitem group by 1
),
staged as (
    select o_orderkey as id, cast(c_nationkey as bigint) as fund_id,
        'Fund ' || c_nationkey as fund_name, p_name as title,
        case when o_orderstatus <> 'O' then lower(c_mktsegment) end as problem,
        case when o_orderstatus <> 'P' then lower(o_orderpriority) end as solution,
        cast(round(o_totalprice * 100) as bigint) as amount_requested,
        case when o_orderstatus = 'F' then cast(round(o_totalprice * 100) as bigint) else 0 end
            as amount_received,
        case when o_orderpriority = '1-URGENT' then 'approved'
             when o_orderpriority = '2-HIGH' then 'pending' else o_orderpriority end as funding_status,
        o_custkey as user_id, yes_votes, no_votes, abstain_votes,
        yes_votes + no_votes + abstain_votes as total_votes,
        o_orderstatus <> 'P' as has_github, links as github_repo_count,
        c_mktsegment as primary_category,
        '[' || c_mktsegment || ', ' || o_orderpriority || ']' as categories,
        strftime(o_orderdate, '%Y-%m-%d') as _loaded_at
    from orders join customer on o_custkey = c_custkey
    left join lines on o_orderkey = l_orderkey
    left join part on first_part = p_partkey
),
texts as (
    select *, lower(title || ' ' || coalesce(problem, '') || ' ' || coalesce(solution, '')) as t
    from staged
),
enriched as (
    select *,
        case when amount_received > 0 then 'funded'
             when funding_status in ('completed', 'approved') then 'approved'
             when funding_status in ('in_progress', 'pending') then 'in_progress'
             else 'not_funded' end as funding_category,
        case when amount_received > 0 then amount_received / nullif(amount_requested, 0) else 0 end
            as funding_ratio,
        case when total_votes > 0 then yes_votes / total_votes end as approval_rate,
        case when has_github and github_repo_count > 0 then true else false end as has_active_github,
        case when {like_any('t', ['widget', 'bolt', 'rod', 'ring'])} then true else false end
            as is_wallet_related,
        case when {like_any('t', ['red', 'large widget'])} then true else false end
            as potential_competitor
    from texts
)"""

ORACLE["staged_proposals"] = f"""with {ENRICHED}
select id, user_id, fund_id, fund_name, title, problem, solution, amount_requested, amount_received,
    funding_status, yes_votes as yes_votes_count, no_votes as no_votes_count,
    abstain_votes as abstain_votes_count, cast(null as bigint) as unique_wallets_voted, has_github,
    categories, cast(null as varchar) as proposal_type, _loaded_at, 'governance_api' as _source
from staged"""

ORACLE["enrich_proposals"] = f"""with {ENRICHED}
select id, fund_id, fund_name, title, amount_requested, amount_received, funding_status,
    funding_category, cast(funding_ratio as double) as funding_ratio, total_votes, approval_rate,
    has_active_github, cast(github_repo_count as integer) as github_repo_count, is_wallet_related,
    potential_competitor, primary_category, _loaded_at, 'governance_api' as _source
from enriched"""

TOKENS = "string_split(replace(replace(categories, '[', ''), ']', ''), ',')"
FUNDING = f"""with {ENRICHED},
metrics as (
    select fund_id, fund_name, n_name as fund_title,
        count(*) as total_funded_projects,
        cast(sum(amount_received) as bigint) as total_funding_distributed,
        avg(amount_received) as avg_funding_per_project,
        median(amount_received) as median_funding_per_project,
        max(amount_received) as max_single_funding,
        count(*) filter (where has_active_github) as projects_with_github,
        count(*) filter (where is_wallet_related) as wallet_ecosystem_projects,
        count(*) filter (where potential_competitor) as potential_competitors,
        count(*) filter (where list_contains({TOKENS}, 'BUILDING')) as building_projects,
        count(*) filter (where list_contains({TOKENS}, '1-URGENT')) as urgent_projects,
        round(avg(approval_rate), 8) as avg_approval_rate,
        round(avg(funding_ratio), 8) as avg_funding_ratio
    from enriched left join nation on fund_id = n_nationkey
    where funding_category = 'funded'
    group by 1, 2, 3
)
select *,
    round(projects_with_github / total_funded_projects * 100, 1) as github_adoption_pct,
    round(wallet_ecosystem_projects / total_funded_projects * 100, 1) as wallet_ecosystem_pct,
    round(potential_competitors / total_funded_projects * 100, 1) as competition_pct
from metrics order by fund_id desc"""
ORACLE["funding_summary"] = FUNDING
ORACLE["funding_summary_sliced"] = FUNDING

SEGMENTS = f"""
segment_text as (
    select enriched.*, n_name as fund_title, lower(title || ' ' || coalesce(solution, '')) as s
    from enriched left join nation on fund_id = n_nationkey
    where is_wallet_related
),
segments as (
    select *, {ladder('s', PART_TYPE, 'infrastructure')} as wallet_type,
        {ladder('s', PART_LEVEL, 'other')} as competition_level
    from segment_text
)"""

ORACLE["segment_projects"] = f"""with {ENRICHED}, {SEGMENTS}
select id, title, fund_title, wallet_type, competition_level, funding_category, amount_received,
    cast(funding_ratio as double) as funding_ratio, has_active_github, approval_rate, solution
from segments
order by case competition_level when 'direct_competitor' then 1 when 'existing_competitor' then 2
    when 'indirect_competitor' then 3 else 4 end, amount_received desc"""


LANDSCAPE = f"""with {ENRICHED}, {SEGMENTS},
metrics as (
    select competition_level, wallet_type, count(*) as project_count,
        count(*) filter (where funding_category = 'funded') as funded_project_count,
        count(*) filter (where has_active_github) as projects_with_github,
        cast(sum(case when funding_category = 'funded' then amount_received else 0 end) as bigint)
            as total_funding_received,
        avg(case when funding_category = 'funded' then amount_received end)
            as avg_funding_per_funded_project,
        round(count(*) filter (where funding_category = 'funded') / count(*) * 100, 1)
            as funding_success_rate,
        round(count(*) filter (where has_active_github) / count(*) * 100, 1) as github_adoption_rate,
        round(avg(approval_rate) * 100, 1) as avg_approval_rate,
        round(avg(funding_ratio) * 100, 1) as avg_funding_ratio
    from segments group by 1, 2
),
placed as (
    select *, row_number() over (
        partition by competition_level, wallet_type order by amount_received desc, id) - 1 as place
    from segments where funding_category = 'funded'
)"""

PAGES = """pages as (
    select competition_level, wallet_type, cast(place // 25 as integer) as examples_page,
        cast(to_json(list(struct_pack(title := title, funding_received := amount_received,
            has_github := has_active_github, github_repos := github_repo_count) order by place))
            as varchar) as top_funded_examples
    from placed group by 1, 2, 3
)"""

SCORE = """cast(case m.competition_level when 'direct_competitor' then 100 when 'existing_competitor' then 75
        when 'indirect_competitor' then 50 when 'ecosystem_enabler' then 25 else 10 end
    + case when funding_success_rate > 30 then 20 else 0 end
    + case when total_funding_received > 10000000000 then 15 else 0 end as integer)
        as strategic_priority_score"""

ORACLE["landscape"] = f"{LANDSCAPE} select m.*, {SCORE} from metrics m"
ORACLE["landscape_examples"] = f"""{LANDSCAPE}
select competition_level, wallet_type, id, title, amount_received as funding_received,
    has_active_github as has_github, cast(github_repo_count as integer) as github_repos, place
from placed"""
ORACLE["landscape_paged"] = ORACLE["landscape_sliced"] = f"""{LANDSCAPE}, {PAGES}
select m.*, coalesce(p.examples_page, 0) as examples_page, p.top_funded_examples, {SCORE}
from metrics m left join pages p
    on m.competition_level = p.competition_level and m.wallet_type = p.wallet_type"""

ORACLE["map_entity_links"] = """with staged as (
    select page_id as id, case when url like 'https%' then url end as website, url as link from pages
),
found as (
    select cast(id as varchar) as project_id, lower(
        case when website like '%example.com%'
                then regexp_extract(website, 'example\\.com/([^/]+/[^/]+)', 1)
             when link like '%example.com%'
                then regexp_extract(link, 'example\\.com/([^/]+/[^/]+)', 1) end) as repo_key
    from staged where website like '%example.com%' or link like '%example.com%'
)
select cast(n_nationkey as varchar) as project_id, lower(n_name) as repo_key, 'seed' as source,
    '2024-01-31 00:00:00' as mapped_at
from nation
union all
select project_id, repo_key, 'discovered', 'load-1' from found
where repo_key is not null and repo_key <> ''"""

PANEL = """with pairs as (
    select distinct cast(o_custkey as varchar) as project_id, 'cust/' || (o_custkey + d.n) as repo_key
    from orders, (values (0), (1)) as d(n)
),
metrics as (
    select lower('Cust/' || o_custkey) as repo_key, count(*) as repos,
        sum(cast(round(o_totalprice * 100) as bigint)) as stars, sum(o_orderkey) as forks
    from orders group by 1
),
links as (
    select project_id, stars, forks, repos from pairs left join metrics using (repo_key)
),
projects as (
    select cast(c_custkey as varchar) as project_id, c_name as title,
        cast(round(c_acctbal * 100) as bigint) as amount_requested, c_mktsegment as funding_status,
        c_acctbal > 0 as has_github
    from customer
)"""
ORACLE["delivery_panel"] = f"""{PANEL}
select p.*, cast(coalesce(stars, 0) as bigint) as github_stars,
    cast(coalesce(forks, 0) as bigint) as github_forks, coalesce(repos, 0) as linked_repos_count,
    l.project_id is not null as has_github_data
from projects p left join links l on p.project_id = l.project_id"""
ORACLE["delivery_panel_per_project"] = f"""{PANEL},
summed as (
    select project_id, sum(stars) as stars, sum(forks) as forks, sum(repos) as repos
    from links group by 1
)
select p.*, cast(coalesce(stars, 0) as bigint) as github_stars,
    cast(coalesce(forks, 0) as bigint) as github_forks,
    cast(coalesce(repos, 0) as bigint) as linked_repos_count,
    l.project_id is not null as has_github_data
from projects p left join summed l on p.project_id = l.project_id"""

# --- incremental loads -------------------------------------------------------

ORACLE["full_load_counts"] = """select event_type, count(*) as n, max(ts) as last_ts
from events group by 1"""

ORACLE["merged_drift"] = """select o_orderkey,
    case when o_orderdate < timestamp '1998-01-01' then o_custkey end as o_custkey,
    case when o_orderdate >= timestamp '1998-01-01' then o_orderpriority end as o_orderpriority
from orders"""

LOADED = """loaded as (
    select event_type || '/' || user_id as repo,
        max(case when event_type <> 'error' then ts end) as fetched_at,
        max(ts - interval 5 day) as updated_at
    from events group by 1
),
fresh as (
    select repo, coalesce(fetched_at, updated_at) as last_updated,
        coalesce(fetched_at, updated_at) > timestamp '2024-01-29' as is_fresh
    from loaded
)"""
ORACLE["freshness_by_key"] = f"with {LOADED} select * from fresh"
ORACLE["stale_keys"] = f"with {LOADED} select repo from fresh where not is_fresh"
ORACLE["freshness_inclusive"] = """select o_custkey, max(o_orderdate) as last_updated,
    epoch(timestamp '2001-08-01' - max(o_orderdate)) / 86400 <= 60 as is_fresh
from orders group by 1"""

ORACLE["watermark_since"] = """with marks as (
    select user_id, event_type, max(ts) as mark from events
    where ts < timestamp '2024-01-20' and value > 50 group by 1, 2
)
select e.* from events e left join marks m
    on e.user_id = m.user_id and e.event_type = m.event_type
where m.mark is null or e.ts > m.mark"""

ORACLE["cap_per_key"] = """select * exclude (n) from (
    select *, row_number() over (partition by user_id order by ts desc, event_id desc) as n from events
) where n <= 5"""
ORACLE["cap_per_key_large"] = """select * exclude (n) from (
    select *, row_number() over (partition by event_type order by ts desc, event_id desc) as n
    from events
) where n <= 1500"""

ORACLE["cap_per_key_even"] = ORACLE["cap_per_key_large"]

ORACLE["state_after_run"] = """with late as (
    select distinct cast(user_id as varchar) as repo from events
    where ts >= timestamp '2024-01-15' and value > 60
),
early as (
    select distinct cast(user_id as varchar) as repo from events where ts < timestamp '2024-01-15'
)
select 'pull_requests#' || repo as pipeline_state_id,
    '2024-01-31T00:00:00+00:00' as last_updated, 'pull_requests' as table_name,
    'prod' as environment, repo as repository_name, 'second' as run
from late
union all
select 'pull_requests#' || repo, '2024-01-15T00:00:00+00:00', 'pull_requests', 'prod', repo, null
from early where repo not in (select repo from late)"""

ORACLE["run_manifest_rows"] = """select 'activity' as source, 'ingestion.complete' as detail_type,
    'prod' as env, 'events_daily' as pipeline, '2024-01-31T00:00:00' as timestamp,
    count(*) as rows_landed, 'bronze' as prefix
from events"""

# --- landed JSON -------------------------------------------------------------

ORACLE["landing_proposals"] = """select cast(o_orderkey // 50 + 1 as integer) as page,
    o_orderkey as id, o_orderpriority as title,
    cast(round(o_totalprice * 100) as bigint) as amount_requested, o_custkey as fund_id,
    '2024-01-31T00:00:00' as ingested_at
from orders"""

ORACLE["landing_funds"] = """select c_custkey as id, c_name as title,
    cast(round(c_acctbal * 100) as bigint) as amount, '2024-01-31T00:00:00' as ingested_at
from customer"""

ORACLE["unwrap_envelope"] = """select event_id, cast(props ->> 'k' as integer) as raw__props__k,
    value as raw__value
from events"""

ORACLE["landing_pull_requests"] = f"""with {RAW_PULLS},
marks as (
    select repository, max(cast(left(made_at, 19) as timestamp)) as mark from raw_pulls
    where made_at < '2024-01-10' and state = 'open' group by 1
),
newer as (
    select r.* from raw_pulls r left join marks m on r.repository = m.repository
    where r.state = 'closed' and r.repository in ('org/click', 'org/view', 'org/error')
        and (mark is null or cast(left(made_at, 19) as timestamp) > mark)
),
capped as (
    select *, row_number() over (partition by repository order by made_at desc, id desc) as n from newer
)
select id, title, made_at as updated_at, login, repository as repository_full_name,
    '2024-01-31T00:00:00' as fetched_at
from capped where n <= 40"""

ORACLE["landing_releases"] = """with raw as (
    select 'supplier/' || l_suppkey as repository_full_name,
        case when l_tax > 0 then strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ') end as published_at
    from lineitem
),
capped as (
    select *, row_number() over (
        partition by repository_full_name order by published_at desc nulls last) as n from raw
)
select repository_full_name, count(*) as n, min(published_at) as first_published
from capped where n <= 10 group by 1"""

ORACLE["landing_issues"] = """select conv_id * 1000 + turn as id, text as title,
    'org/' || role as repository_full_name, '2024-01-31T00:00:00' as fetched_at
from conversations where role <> 'assistant'"""

ORACLE["landing_repositories"] = """select o_orderkey as id, 'Cust/' || o_custkey as full_name,
    cast(round(o_totalprice * 100) as bigint) as stargazers_count,
    '2024-01-31T00:00:00' as fetched_at
from orders"""

# --- checks and reports ------------------------------------------------------

ORACLE["quality_report"] = f"""with {RAW_PULLS},
checks as (
    select 'customer.c_custkey unique' as check_name, (select count(*) from (
        select c_custkey from customer group by 1 having count(*) > 1)) as failing
    union all select 'customer.c_name not_null', (select count(*) from customer where c_name is null)
    union all select 'orders.o_orderstatus accepted',
        (select count(*) from orders where o_orderstatus not in ('O', 'F'))
    union all select 'orders.o_custkey parent', (select count(*) from orders
        where o_custkey is not null and o_custkey not in (select c_custkey from customer))
    union all select 'lineitem.l_orderkey parent', (select count(*) from lineitem
        where l_orderkey is not null and l_orderkey not in (select o_orderkey from orders))
    union all select 'lineitem key unique', (select count(*) from (
        select l_orderkey from lineitem group by l_orderkey, l_linenumber having count(*) > 1))
    union all select 'pull_requests.feat_classifier accepted', (select count(*) from raw_pulls
        where {PULL_CLASS} not in
            ('bug fix', 'feature', 'refactor', 'test', 'documentation', 'not clear'))
    union all select 'pull_requests.closed_at not_null',
        (select count(*) from raw_pulls where closed_at is null)
    union all select 'orders columns', (select count(*) from (values ('o_orderkey'), ('o_comment')) v(c)
        where c not in (select column_name from (describe orders)))
)
select *, failing = 0 as passed from checks"""

ORACLE["null_counts"] = """select 'id' as column_name, count(*) filter (where c_custkey is null) as failing
from customer
union all select 'title', count(*) filter (where c_name is null) from customer
union all select 'website', count(*) filter (where c_mktsegment is distinct from 'BUILDING') from customer
union all select 'link', count(*) filter (where coalesce(c_acctbal, 0) <= 0) from customer"""

ORACLE["status_counts"] = " union all ".join(
    f"select '{t}' as table_name, count(*) as row_count from {t}"
    for t in ("region nation customer supplier part orders lineitem events documents embeddings "
              "pages benchmark labels conversations").split()
) + " union all select 'not_loaded', null"

ORACLE["ecosystem_summary"] = f"""with {ENRICHED},
base as (
    select primary_category as category, coalesce(has_github, false) as repo, amount_requested as amount,
        coalesce(case when amount_received > 0 then 'funded'
            when funding_status <> '5-LOW' then funding_status end, 'Unknown') as status
    from staged
)
select 'totals' as section, 'total_proposals' as name, count(*) as count, cast(null as bigint) as total_amount
from base
union all select 'totals', 'github_proposals', count(*) filter (where repo), null from base
union all select 'totals', 'funded_proposals', count(*) filter (where status = 'funded'), null from base
union all select 'totals', 'funded_github_proposals',
    count(*) filter (where status = 'funded' and repo), null from base
union all select 'categories', category, count(*), cast(null as bigint) from base group by 2
union all select 'funding_status', status, count(*), cast(sum(amount) as bigint) from base group by 2"""

# --- streams -----------------------------------------------------------------

ORACLE["suite_report"] = """with checks as (
    select 'customer.c_name not_null' as check_name, (select count(*) from customer where c_name is null) as failing
    union all select 'customer.c_acctbal not_null', (select count(*) from customer where c_acctbal is null)
    union all select 'customer.c_custkey unique', (select count(*) from (
        select c_custkey from customer where c_custkey is not null group by 1 having count(*) > 1))
    union all select 'customer columns', 1
    union all select 'lineitem.l_shipdate not_null', (select count(*) from lineitem where l_shipdate is null)
    union all select 'lineitem.l_returnflag accepted', (select count(*) from lineitem where l_returnflag not in ('A', 'N'))
    union all select 'lineitem.l_linestatus accepted', (select count(*) from lineitem where l_linestatus not in ('O', 'F'))
    union all select 'lineitem.l_orderkey+l_linenumber unique', (select count(*) from (
        select l_orderkey from lineitem where l_orderkey is not null and l_linenumber is not null
        group by l_orderkey, l_linenumber having count(*) > 1))
    union all select 'events.ts not_null', (select count(*) from events where ts is null)
    union all select 'events.value not_null', (select count(*) from events where value is null)
    union all select 'events.event_type accepted', (select count(*) from events where event_type not in ('click', 'error'))
)
select *, failing = 0 as passed from checks"""

ORACLE["checks_while_writing"] = f"""with {RAW_PULLS},
checks as (
    select 'pulls.repository not_null' as check_name, (select count(*) from raw_pulls where repository is null) as failing
    union all select 'pulls.closed_at not_null', (select count(*) from raw_pulls where closed_at is null)
    union all select 'pulls.feat_classifier accepted', (select count(*) from raw_pulls
        where {PULL_CLASS} not in ('feature', 'not clear'))
    union all select 'pulls.id unique', (select count(*) from (
        select id from raw_pulls where id is not null group by id having count(*) > 1))
    union all select 'pulls.repository+title unique', (select count(*) from (
        select 1 from raw_pulls where repository is not null and title is not null group by repository, title having count(*) > 1))
)
select *, failing = 0 as passed from checks"""

ORACLE["sketched_quantiles"] = """select event_type, quartile, count(value) as n, true as within
from events, (values ('q25'), ('q50'), ('q75')) q(quartile) group by event_type, quartile"""

ORACLE["stream_upsert"] = """select * exclude (n) from (
    select *, row_number() over (partition by user_id order by ts desc, event_id desc) as n from events
) where n = 1"""

ORACLE["incremental_monthly"] = """select o_orderstatus as status,
    cast(date_trunc('month', o_orderdate) as timestamp) as month, count(*) as order_count,
    cast(sum(cast(round(o_totalprice * 100) as bigint)) as bigint) as amount
from orders group by 1, 2"""

ORACLE["merged_levels"] = ORACLE["stream_upsert"]
ORACLE["loaded_ranges"] = "select event_id, event_type, 1::bigint as loads from events"
ORACLE["stream_daily_to_monthly"] = """select event_type,
    cast(date_trunc('month', ts) as timestamp) as month, count(*) as event_count
from events group by 1, 2"""

ORACLE["stream_ingest"] = """select o_orderkey as id, 'Cust/' || o_custkey as full_name,
    cast(round(o_totalprice * 100) as bigint) as stargazers_count,
    strftime(o_orderdate, '%Y-%m-%d') as created_at
from orders"""
