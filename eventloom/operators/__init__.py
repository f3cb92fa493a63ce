"""DataFrame operators: ingest transforms, statistics, leaderboards, views."""
