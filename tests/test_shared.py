"""Reports from one scan of the log are those from the log."""

import pytest

from loadglass.__main__ import main
from loadglass.operators.cleaning import clean_log
from loadglass.plans import bundles, rollup, shared
from loadglass.sources import events, logs
from plan_text import executed_scans


@pytest.fixture(scope="module")
def path(spark, folder, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("clean") / "log")
    logs.write_clean_log(clean_log(events.raw_log(spark, folder)), path)
    return path


@pytest.fixture(scope="module")
def log(spark, path):
    return logs.read_clean_log(spark, path)


@pytest.fixture(scope="module")
def direct(log):
    return bundles.static_report(log) | bundles.dashboard(log)


@pytest.fixture(scope="module")
def tables(log):
    return shared.shared_tables(log)


def test_all_reports_of_both_sets(log, direct, tables):
    assert set(tables) == set(direct)
    assert set(shared.STATIC) == set(bundles.static_report(log))
    assert set(shared.DASHBOARD) == set(bundles.dashboard(log))


@pytest.mark.parametrize("name", [*shared.REPORTS, *shared.WHOLE_LOG])
def test_same_table(direct, tables, name):
    expected = direct[name]
    assert tables[name].schema.simpleString() == expected.schema.simpleString()
    assert tables[name].collect() == expected.collect()


def test_the_log_is_scanned_once(log, path):
    sets = shared.grouping_sets(shared.needs([*shared.REPORTS, *shared.WHOLE_LOG]))
    assert executed_scans(shared.grouped(log, sets)) == 1


def test_tables_do_not_read_the_log(tables, path):
    for table in tables.values():
        files = table.inputFiles()
        assert files and not any(path in file for file in files)


def test_no_set_includes_another():
    sets = shared.grouping_sets(shared.needs([*shared.REPORTS, *shared.WHOLE_LOG]))
    assert len(sets) == 6
    assert not any(set(a) < set(b) for a in sets for b in sets)
    assert shared.grouping_sets(shared.needs(["requests_by_hour"])) == [("error", "hour")]


def test_missing_keys_are_not_other_sets(spark, make_clean):
    rows = [("2024-03-05 10:00:00", "auth", "/login", 5, 200, False)] * 3
    rows += [("2024-03-05 10:00:00", None, "/login", 7, 500, True), ("2024-03-05 23:00:00", "auth", None, 9, 200, False)]
    log = make_clean(rows)
    direct = bundles.static_report(log) | bundles.dashboard(log)
    for name, table in shared.shared_tables(log).items():
        assert table.collect() == direct[name].collect(), name


def test_empty_log(make_clean):
    log = make_clean([]).limit(0)
    direct = bundles.static_report(log) | bundles.dashboard(log)
    for name, table in shared.shared_tables(log).items():
        assert table.collect() == direct[name].collect(), name


def test_from_a_rollup(log, direct):
    rolled = rollup.with_calendar(rollup.roll_up(log))
    found = shared.shared_tables(rolled, ["kpis", "daily_metrics"])
    assert found["kpis"].collect() == direct["kpis"].collect()
    assert found["daily_metrics"].collect() == direct["daily_metrics"].collect()


def test_command_line(spark, path, tmp_path):
    main(["--master", "local[2]", "report", "--clean", path, "--tables", str(tmp_path), "--set", "published"])
    assert sorted(p.name for p in tmp_path.iterdir()) == sorted(shared.PUBLISHED)
    with pytest.raises(SystemExit):
        main(["report", "--clean", path, "--tables", str(tmp_path), "--set", "load-model"])
