"""Names and types shared by every job."""

from __future__ import annotations

# Event kinds as the archive spells them.
WATCH = "WatchEvent"
FORK = "ForkEvent"
PUSH = "PushEvent"
PULL_REQUEST = "PullRequestEvent"
ISSUES = "IssuesEvent"
CREATE = "CreateEvent"

# One archive line. Ids and flags are read as text and cast later, so that an
# odd value spoils its own field and not the whole line.
ARCHIVE_LINE = """
    id string, type string, public string, created_at string,
    actor struct<id string, login string, display_login string,
                 gravatar_id string, url string, avatar_url string>,
    repo struct<id string, name string, url string>,
    org struct<id string, login string, gravatar_id string, url string, avatar_url string>,
    payload string
"""

PUSH_PAYLOAD = "push_id string, size string, distinct_size string, head string, ref string"
FORK_PAYLOAD = "forkee struct<id string, full_name string>"
CREATE_PAYLOAD = "ref string, ref_type string, description string"

EVENTS = """
    gh_event_id bigint, event_type string, public int,
    created_at timestamp_ntz, created_at_date date,
    actor_id bigint, repo_id bigint, org_id bigint,
    actor_login string, repo_name string
"""

ACTORS = """
    actor_id bigint, login string, display_login string, gravatar_id string,
    url string, avatar_url string,
    total_events bigint, total_repos bigint, last_active_at timestamp_ntz
"""

REPOS = """
    repo_id bigint, name string, url string,
    total_stars bigint, total_forks bigint, total_events bigint,
    total_contributors bigint, last_event_at timestamp_ntz, language string, is_hot int
"""

ORGANIZATIONS = """
    org_id bigint, login string, gravatar_id string, url string, avatar_url string,
    total_repos bigint, total_members bigint
"""

RELATIONS = """
    actor_id bigint, repo_id bigint, relation_type string, relation_time timestamp_ntz,
    first_event_at timestamp_ntz, last_event_at timestamp_ntz, event_count bigint
"""

DAILY_STATS = """
    stats_date date, event_type string, total_count bigint,
    unique_actors bigint, unique_repos bigint, unique_orgs bigint
"""

# The tables, by name. Unsigned 32-bit columns are bigint; scores are doubles.
TABLES = {
    "actors": ACTORS,
    "repos": REPOS,
    "organizations": ORGANIZATIONS,
    "events": f"payload_id bigint, {EVENTS}",
    "payload_push": """payload_id bigint, gh_event_id bigint, push_id bigint, size int,
        distinct_size int, head string, ref string""",
    "payload_star": "payload_id bigint, gh_event_id bigint, action string, star_repo_id bigint",
    "payload_fork": "payload_id bigint, gh_event_id bigint, forkee_id bigint, forkee_name string",
    "payload_create": """payload_id bigint, gh_event_id bigint, ref string, ref_type string,
        description string""",
    "user_repo_relation": RELATIONS,
    "event_stats_daily": f"{DAILY_STATS}, stats_time timestamp_ntz",
    "hot_repos": """repo_id bigint, repo_name string, score double, stars_7d bigint,
        forks_7d bigint, prs_7d bigint, contributors_7d bigint, rank_position bigint,
        updated_at timestamp_ntz""",
    "active_developers": """actor_id bigint, actor_login string, activity_score double,
        commits_7d bigint, prs_7d bigint, issues_7d bigint, repos_7d bigint,
        rank_position bigint, updated_at timestamp_ntz""",
    "repo_stats_cache": """repo_id bigint, total_stars bigint, total_forks bigint,
        total_watchers bigint, total_contributors bigint, total_commits bigint,
        total_prs bigint, total_issues bigint, stars_1d bigint, stars_7d bigint,
        stars_30d bigint, updated_at timestamp_ntz""",
    "actor_stats_cache": """actor_id bigint, total_commits bigint, total_prs bigint,
        total_issues bigint, total_repos bigint, total_stars_received bigint,
        commits_7d bigint, prs_7d bigint, repos_7d bigint, updated_at timestamp_ntz""",
}
