"""The checks each model declares, run while it is built."""

from __future__ import annotations

from siltstone import rules
from siltstone.operators.quality import Suite

# Which columns must be there, unique, not null, or hold listed labels.
SUITES = {
    "stg_funds": Suite(not_null=("id",), unique=(("id",),)),
    "stg_proposals": Suite(not_null=("id", "fund_id", "title"), unique=(("id",),)),
    "stg_pull_requests": Suite(
        not_null=("repository", "number", "feat_classifier"), unique=(("id",),),
        accepted=(("feat_classifier", tuple(rules.PR_TITLE_LABELS)),)),
    "stg_releases": Suite(not_null=("repository", "tag", "row_num")),
}
