from __future__ import annotations

import gzip
import json
from datetime import datetime

import pytest

from eventloom.schemas import ACTORS, ORGANIZATIONS, REPOS
from parity.check import session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    return session(cpus=8, folder=str(tmp_path_factory.mktemp("staging")))


@pytest.fixture(scope="session")
def make_events(spark):
    """Events from (id, type, time, actor, repo, org) tuples."""

    def make(rows):
        full = []
        for event_id, kind, time, actor, repo, org in rows:
            at = datetime.fromisoformat(time)
            full.append(
                (event_id, f"{kind}Event", 1, at, at.date(), actor, repo, org, f"dev-{actor}", f"org/repo-{repo}")
            )
        schema = """gh_event_id bigint, event_type string, public int, created_at timestamp_ntz,
            created_at_date date, actor_id bigint, repo_id bigint, org_id bigint,
            actor_login string, repo_name string"""
        return spark.createDataFrame(full, schema)

    return make


def table(spark, schema, rows):
    names = [part.split()[0] for part in schema.replace("\n", " ").split(",")]
    return spark.createDataFrame([tuple(row.get(n) for n in names) for row in rows], schema)


@pytest.fixture(scope="session")
def make_actors(spark):
    return lambda *rows: table(
        spark, ACTORS, [{"login": f"dev-{r['actor_id']}", "total_events": 0, **r} for r in rows]
    )


@pytest.fixture(scope="session")
def make_repos(spark):
    return lambda *rows: table(
        spark,
        REPOS,
        [
            {"name": f"org/repo-{r['repo_id']}", "total_stars": 0, "total_forks": 0, "total_events": 0, **r}
            for r in rows
        ],
    )


@pytest.fixture(scope="session")
def make_orgs(spark):
    return lambda *rows: table(spark, ORGANIZATIONS, [{"login": f"team-{r['org_id']}", **r} for r in rows])


def line(event_id=1, kind="PushEvent", actor=1, repo=1, time="2024-01-05T10:00:00Z", **more):
    event = {
        "id": str(event_id),
        "type": kind,
        "actor": {"id": actor, "login": f"dev-{actor}"},
        "repo": {"id": repo, "name": f"org/repo-{repo}"},
        "created_at": time,
        "public": True,
        "payload": {},
    }
    event.update(more)
    return json.dumps({k: v for k, v in event.items() if v != "absent"})


@pytest.fixture(scope="session")
def parsed(spark):
    """Parsed lines from text lines, in the given order."""
    from eventloom.sources.archive import LINE_SCHEMA, parse_lines

    def make(*lines):
        hour = datetime(2024, 1, 5, 10)
        rows = [(text, hour, n) for n, text in enumerate(lines)]
        return parse_lines(spark.createDataFrame(rows, LINE_SCHEMA))

    return make


def write_hour(folder, name, lines, keep=None):
    """An hour file; ``keep`` cuts the compressed file off after so many bytes."""
    data = gzip.compress("".join(f"{text}\n" for text in lines).encode())
    (folder / f"{name}.json.gz").write_bytes(data[:keep])


def rows(df, *order):
    return [tuple(row) for row in (df.orderBy(*order) if order else df).collect()]
