"""Random inputs against the plainest possible Python."""

import json
import random
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import functions as F

from helpers import land, raw_frame, raw_row, record
from tallyhouse.functions import infer_language, last_path_part, short_repo_label, split_repo
from tallyhouse.operators import marts
from tallyhouse.operators.staging import stage_events
from tallyhouse.plans.daily import load_dates
from tallyhouse.schemas import LANGUAGE_HINTS
from tallyhouse.sources.landing import Landing
from tallyhouse.sources.tables import ensure_table


def random_rows(rng, n):
    """Few ids, few timestamps, many gaps: ties and repeats everywhere."""
    start = datetime(2024, 5, 1, tzinfo=timezone.utc)
    for _ in range(n):
        when = start + timedelta(hours=rng.randrange(60))
        yield raw_row(
            rng.choice([None, *map(str, range(n // 3))]),
            rng.choice([None, when.strftime("%Y-%m-%dT%H:%M:%S")]) if rng.random() < 0.2
            else when.strftime("%Y-%m-%dT%H:%M:%S"),
            type=rng.choice([None, "PushEvent", "CreateEvent", "WatchEvent", "ForkEvent"]),
            actor=rng.choice([None, "a", "b", "c"]),
            repo=rng.choice([None, "o/go", "o/java", "solo"]),
            payload=rng.choice([None, '{"x":1}', '{"x":2}']),
            public=rng.choice([None, True, False]),
        )


def staged_by_hand(rows):
    best = {}
    for id, type, actor, repo, payload, public, when, _ in rows:
        if None in (id, type, when):
            continue
        parts = [
            type,
            repo and json.loads(repo)["name"],
            repo and str(json.loads(repo)["id"]),
            actor and json.loads(actor)["login"],
            actor and str(json.loads(actor)["id"]),
            None,
            public,
            payload,
        ]
        rank = (when, [(p is not None, p if p is not None else 0) for p in parts])
        if id not in best or rank > best[id][0]:
            best[id] = (rank, (id, when.replace(tzinfo=None), *parts))
    return sorted(row for _, row in best.values())


def test_staging_and_marts(spark):
    rows = list(random_rows(random.Random(5), 1500))
    stg = stage_events(raw_frame(spark, *rows)).cache()
    got = [
        tuple(r)
        for r in stg.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp_ntz")).collect()
    ]
    expected = staged_by_hand(rows)
    assert sorted(got, key=lambda r: r[0]) == expected

    by_type, repos, pushes = {}, {}, {}
    for _, when, kind, repo, _, actor, *_ in expected:
        by_type.setdefault((when.date(), kind), []).append((actor, repo))
        if repo is not None:
            repos.setdefault((when.date(), repo), []).append((actor, kind))
        if kind in ("PushEvent", "CreateEvent"):
            pushes.setdefault((when.date(), repo), []).append(actor)

    def known(values):
        return len({v for v in values if v is not None})

    assert {(r[0], r[1]): tuple(r)[2:] for r in marts.events_by_type(stg).collect()} == {
        k: (len(v), known(a for a, _ in v), known(r for _, r in v)) for k, v in by_type.items()
    }
    assert {(r[0], r[1]): (r.total_events, r.stars, r.forks, r.pushes, r.unique_contributors)
            for r in marts.top_repos(stg).collect()} == {
        k: (len(v), *[sum(t == x for _, t in v) for x in ("WatchEvent", "ForkEvent", "PushEvent")],
            known(a for a, _ in v))
        for k, v in repos.items()
    }
    assert {(r.event_date, r.repo_name): (r.push_count, r.contributors)
            for r in marts.repo_push_activity(stg).collect()} == {
        k: (len(v), known(v)) for k, v in pushes.items()
    }


def test_names(spark):
    rng = random.Random(11)
    pieces = ["go", "Java", "script", "py", "THON", "rust", "type", "ruby", "-", "_", "php", "c", "pp",
              "sharp", "é", "ß", "日本", "x" * 9, " "]
    names = {
        "/".join(
            "".join(rng.choices(pieces, k=rng.randrange(0, 6))) for _ in range(rng.randrange(1, 4))
        )
        for _ in range(800)
    }
    df = spark.createDataFrame([(n,) for n in sorted(names)], "n string")
    rows = df.select(
        "n", split_repo("n", 0), split_repo("n", 1), last_path_part("n"), short_repo_label("n"),
        infer_language(split_repo("n", 1)),
    ).collect()
    for name, owner, short, last, label, language in rows:
        parts = name.split("/")
        assert owner == parts[0] and last == parts[-1]
        assert short == (parts[1] if len(parts) > 1 else None)
        tail = "/".join(parts[-2:])
        assert label == (tail if len(tail) <= 28 else tail[:25] + "...")
        hits = [lang for needle, lang in LANGUAGE_HINTS if short and needle in short.lower()]
        assert language == (hits[0] if hits else None)


def test_range_loads(spark, tmp_path):
    """Loading a range at once, against a list that is filtered and extended per day."""
    from acceptance.warehouse import fresh_database

    rng = random.Random(3)
    every = [date(2024, 5, 1) + timedelta(n) for n in range(6)]
    for turn in range(3):
        root = tmp_path / str(turn)
        files = {}
        for day in every[1:5]:
            if rng.random() < 0.25:
                continue
            files[day] = [
                (f"{day}#{n}", rng.choice([day, day, day, *every, None])) for n in range(8)
            ]
            for hour in (3, 4):
                land(root, str(day), hour, [
                    record(i, d and f"{d}T0{hour}:00:00") for n, (i, d) in enumerate(files[day])
                    if n % 2 == hour % 2
                ])
        table = [(f"old{d}", d) for d in every]
        database = fresh_database(spark, "brute")
        ensure_table(spark, f"{database}.raw_events")
        raw_frame(spark, *[raw_row(i, f"{d}T00:00:00") for i, d in table]).withColumn(
            "event_date", F.to_date("created_at")
        ).write.insertInto(f"{database}.raw_events")
        for _ in range(2):
            for day, rows in sorted(files.items()):
                table = [r for r in table if r[1] != day] + rows
            load_dates(spark, database, Landing(str(root)), every)
            got = spark.table(f"{database}.raw_events").select("id", "event_date").collect()
            assert sorted(map(tuple, got), key=str) == sorted(table, key=str)


def test_refresh_equals_rebuild(spark, tmp_path):
    """Copies move between dates as single dates are replaced again and again."""
    from acceptance.warehouse import fresh_database
    from tallyhouse.plans import daily

    rng = random.Random(21)
    every = [date(2024, 5, 1) + timedelta(n) for n in range(5)]
    kinds = ["PushEvent", "CreateEvent", "WatchEvent", "ForkEvent", "IssuesEvent"]

    def docs(day, n):
        for _ in range(n):
            strayed = rng.choice([day] * 8 + every)
            when = f"{strayed}T{rng.randrange(24):02d}:{rng.randrange(60):02d}:00"
            yield record(
                str(rng.randrange(60)),
                when,
                rng.choice(kinds),
                actor=rng.choice("abc"),
                repo=rng.choice(["o/go", "o/x"]),
            )

    def tables(database):
        return {
            name: sorted(map(str, df.collect()))
            for name, df in daily.stored_tables(spark, database).items()
        }

    root, database = tmp_path / "landed", fresh_database(spark, "refreshed")
    layout = Landing(str(root))
    for day in every:
        land(root, str(day), 0, docs(day, 25))
        land(root, str(day), 1, [record(f"{day}{k}", f"{day}T00:00:00", k) for k in kinds])
    load_dates(spark, database, layout, every)
    daily.rebuild(spark, database)
    rewritten = []
    for turn in range(5):
        day = rng.choice(every)
        few = [record("only", f"{day}T01:00:00")]
        land(root, str(day), 0, few if turn == 2 else docs(day, rng.choice([0, 5, 30])))
        result = load_dates(spark, database, layout, [day])
        rewritten.append(len(daily.refresh(spark, database, result.changed_dates)))
        refreshed = tables(database)
        daily.rebuild(spark, database)
        assert refreshed == tables(database)
    assert min(rewritten) < len(every)
