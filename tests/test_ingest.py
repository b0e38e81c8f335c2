import random

import pytest

from claimweave.operators import logs
from claimweave.sinks import folders, snapshots
from claimweave.sinks.snapshots import Manifest, Snapshots
from claimweave.sources.logs import located_lines, read_log_lines
from claimweave.streaming import ingest
from row_sets import rows
from test_logs import HEAD, random_files

COLUMNS = ["pos", "timestamp", "message", "details", "log_level", "time_diff_seconds"]


def write(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(text) + "\n")


def state(spark, store):
    tables = {n: rows(ingest.read_summary(spark, store, n)) for n in ingest.SUMMARY_KEYS}
    return rows(ingest.read_entries(spark, store).select(*COLUMNS)), tables


def test_increments_in_any_order_equal_a_full_reload(spark, tmp_path):
    files = {n: t for n, t in random_files(31, files=6).items() if t}
    names = list(files)
    random.Random(2).shuffle(names)
    inbox, store, checkpoint = tmp_path / "in", str(tmp_path / "store"), str(tmp_path / "cp")
    for group in (names[:2], names[2:3], names[3:]):
        for n in group:
            write(inbox, f"{n}.log", files[n])
        ingest.ingest_new_logs(spark, str(inbox), store, checkpoint)
    incremental = state(spark, store)
    assert len(incremental[0]) == logs.assemble_entries(read_log_lines(spark, str(inbox))).count()
    ingest.full_reload(spark, str(inbox), store, str(tmp_path / "cp2"))
    assert state(spark, store) == incremental
    direct = logs.assemble_entries(read_log_lines(spark, str(inbox)))
    assert incremental[1]["hourly"] == rows(logs.hourly_summary(direct))
    assert incremental[1]["user"] == rows(logs.count_by(direct, "username"))
    assert incremental[1]["level"] == rows(logs.level_counts(direct))
    assert rows(ingest.read_stats(spark, store)) == rows(logs.log_stats(direct))


def test_a_file_loads_once(spark, tmp_path):
    inbox, store, checkpoint = tmp_path / "in", str(tmp_path / "store"), str(tmp_path / "cp")
    write(inbox, "a.log", [HEAD.format(s=1, level="INFO", text="one")])
    write(inbox, "skipped.txt", [HEAD.format(s=1, level="INFO", text="no log")])
    ingest.ingest_new_logs(spark, str(inbox), store, checkpoint)
    ingest.ingest_new_logs(spark, str(inbox), store, checkpoint)
    write(inbox / "copy", "a.log", [HEAD.format(s=1, level="INFO", text="same base name")])
    ingest.ingest_new_logs(spark, str(inbox), store, checkpoint)
    assert ingest.read_entries(spark, store).count() == 2
    assert rows(ingest.read_summary(spark, store, "user")) == [("ann", 2)]


@pytest.mark.parametrize("order", [("a", "b"), ("b", "a"), ("ab",)])
def test_equal_base_names_load_in_any_order(spark, tmp_path, order):
    inbox, store = tmp_path / "in", str(tmp_path / "store")
    for arrived in order:
        for folder in arrived:
            write(inbox / folder, "app.log", [HEAD.format(s=1, level="INFO", text=folder)])
        ingest.ingest_new_logs(spark, str(inbox), store, str(tmp_path / "cp"))
    assert sorted(r.message for r in ingest.read_entries(spark, store).collect()) == ["a", "b"]
    before = state(spark, store)
    ingest.full_reload(spark, str(inbox), store, str(tmp_path / "cp2"))
    assert state(spark, store) == before


def test_a_flat_folder_knows_files_by_name(spark, tmp_path):
    inbox, store, checkpoint = tmp_path / "in", str(tmp_path / "store"), str(tmp_path / "cp")
    for _ in range(2):
        write(inbox, "a.log", [HEAD.format(s=1, level="INFO", text="one")])
        write(inbox / "deeper", "b.log", [HEAD.format(s=1, level="INFO", text="not looked at")])
        ingest.ingest_new_logs(spark, str(inbox), store, checkpoint, flat_folder=True)
    assert ingest.read_entries(spark, store).count() == 1


def test_a_store_is_added_to_under_its_own_checkpoint_only(spark, tmp_path):
    inbox, store, checkpoint = tmp_path / "in", str(tmp_path / "store"), str(tmp_path / "cp")
    write(inbox, "a.log", [HEAD.format(s=1, level="INFO", text="one"), HEAD.format(s=2, level="INFO", text="two")])
    ingest.ingest_new_logs(spark, str(inbox), store, checkpoint)
    (inbox / "a.log").unlink()
    write(inbox, "b.log", [HEAD.format(s=3, level="INFO", text="three")])
    before = state(spark, store)
    with pytest.raises(ValueError, match="checkpoint"):
        ingest.ingest_new_logs(spark, str(inbox), store, str(tmp_path / "other"))
    folders.swap(spark, None, checkpoint)
    with pytest.raises(ValueError, match="checkpoint"):
        ingest.ingest_new_logs(spark, str(inbox), store, checkpoint)
    assert state(spark, store) == before


def test_a_used_checkpoint_does_not_start_a_new_store(spark, tmp_path):
    inbox, checkpoint = tmp_path / "in", str(tmp_path / "cp")
    write(inbox, "a.log", [HEAD.format(s=1, level="INFO", text="one")])
    ingest.ingest_new_logs(spark, str(inbox), str(tmp_path / "store"), checkpoint)
    with pytest.raises(ValueError, match="full_reload"):
        ingest.ingest_new_logs(spark, str(inbox), str(tmp_path / "lost"), checkpoint)


def test_a_failed_reload_keeps_the_store(spark, tmp_path, monkeypatch):
    inbox, store = tmp_path / "in", str(tmp_path / "store")
    write(inbox, "a.log", [HEAD.format(s=1, level="INFO", text="one")])
    ingest.ingest_new_logs(spark, str(inbox), store, str(tmp_path / "cp"))
    before = state(spark, store)
    monkeypatch.setattr(ingest, "_run", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        ingest.full_reload(spark, str(inbox), store, str(tmp_path / "cp2"))
    assert state(spark, store) == before


def raw_lines(spark, inbox, names):
    raw = spark.read.text([str(inbox / n) for n in names]).select("value", "_metadata.file_path", "_metadata.file_block_start")
    return raw


def test_a_load_writes_what_it_brings(spark, tmp_path, monkeypatch):
    """The layers of a load are as large as the load; merges keep the number of layers low."""
    monkeypatch.setattr(ingest, "FAN_IN", 3)
    inbox, root = tmp_path / "in", str(tmp_path / "store")
    write(inbox, "a.log", [HEAD.format(s=s, level="INFO", text=f"one{s}") for s in range(10)])
    lines, store = raw_lines(spark, inbox, ["a.log"]), Snapshots(spark, root)
    ingest._claim_store(store, str(tmp_path / "cp"))
    sizes = []
    for i in range(8):
        before = {layer.path for layer in store.latest().tables["partials"]}
        ingest._load(lines, store, i)
        new = [layer for layer in store.latest().tables["partials"] if layer.path not in before and layer.facts["level"] == 0]
        sizes += [store.read((layer,), ingest.PARTIALS).count() for layer in new]
        levels = [layer.facts["level"] for layer in store.latest().tables["partials"]]
        assert max(levels.count(level) for level in levels) < ingest.FAN_IN
    assert len(set(sizes)) == 1
    n = 10 * 8
    assert rows(ingest.read_summary(spark, root, "user")) == [("ann", n)]
    assert levels.count(0) == 2 and levels.count(1) == 2
    assert rows(ingest.LogSnapshot(spark, root).files().groupBy("file").count())[0][1] == 8
    # Folders of layers that were merged away are gone, but for those the version before still names.
    named = store.latest().paths() | store.at(store.versions()[-2]).paths()
    assert {f"data/{p}" for p in folders.names(spark, f"{root}/data")} == named


def test_a_repeated_load_changes_nothing(spark, tmp_path):
    inbox, root = tmp_path / "in", str(tmp_path / "store")
    write(inbox, "a.log", [HEAD.format(s=1, level="INFO", text="one")])
    write(inbox, "b.log", [HEAD.format(s=2, level="INFO", text="two")])
    store = Snapshots(spark, root)
    ingest._claim_store(store, str(tmp_path / "cp"))
    for load_id, name in ((0, "a.log"), (0, "a.log"), (1, "b.log"), (1, "b.log"), (0, "a.log")):
        ingest._load(raw_lines(spark, inbox, [name]), store, load_id)
    assert rows(ingest.read_summary(spark, root, "user")) == [("ann", 2)]
    assert ingest.read_entries(spark, root).count() == 2
    with pytest.raises(ValueError, match="follow"):
        ingest._load(raw_lines(spark, inbox, ["a.log"]), store, 3)


class Lost(Exception):
    pass


def failing(monkeypatch, step):
    """From now on the step-th file-system step of a store fails; returns which have been made."""
    made = []

    def wrap(name, owner):
        real = getattr(owner, name)

        def call(*args, **kwargs):
            made.append(name)
            if len(made) > step:
                raise Lost(name)
            return real(*args, **kwargs)

        monkeypatch.setattr(owner, name, call)

    wrap("put_text", snapshots)
    wrap("delete", snapshots)
    wrap("write", Snapshots)
    return made


def test_a_load_that_failed_at_any_step_is_done_by_a_retry(spark, tmp_path, monkeypatch):
    inbox, loads = tmp_path / "in", []
    for name, level in (("a", "INFO"), ("b", "WARN")):
        write(inbox, f"{name}.log", [HEAD.format(s=1, level=level, text=name), "more"])
        ready = logs.assemble_entries(located_lines(raw_lines(spark, inbox, [f"{name}.log"])))
        loads.append(spark.createDataFrame(ready.collect(), ready.schema).coalesce(1))
    # The steps in question are the store's; lines are assembled once.
    monkeypatch.setattr(ingest, "located_lines", lambda lines: lines)
    monkeypatch.setattr(ingest, "assemble_entries", lambda lines: lines)

    def state(spark, root):
        now = ingest.LogSnapshot(spark, root)
        assert rows(now.files().select("entries")) == [(1,)] * now.entries().count()
        return rows(now.entries().select("message")), rows(now.summary("level"))

    def loaded(root, upto):
        store = Snapshots(spark, root)
        ingest._claim_store(store, str(tmp_path / "cp"))
        for load_id in range(upto):
            ingest._load(loads[load_id], store, load_id)
        return store

    whole = {n: state(spark, loaded(str(tmp_path / f"whole{n}"), n).root) for n in (0, 1, 2)}
    step, over = 0, False
    while not over:
        for load_id in (0, 1):
            root = str(tmp_path / f"store{load_id}-{step}")
            store = loaded(root, load_id)
            with pytest.MonkeyPatch.context() as patch:
                made = failing(patch, step)
                try:
                    ingest._load(loads[load_id], store, load_id)
                    over = len(made) <= step
                except Lost:
                    pass
            now = ingest.LogSnapshot(spark, root)
            committed = now.manifest.facts["load_id"] == load_id
            assert state(spark, root) == whole[load_id + 1 if committed else load_id]
            ingest._load(loads[load_id], store, load_id)
            if load_id == 0:
                ingest._load(loads[1], store, 1)
            assert state(spark, root) == whole[2]
        step += 1
    assert step >= 10


@pytest.mark.parametrize("failed_load", [0, 1])
def test_a_stream_goes_on_after_a_failed_load(spark, tmp_path, monkeypatch, failed_load):
    inbox, root, checkpoint = tmp_path / "in", str(tmp_path / "store"), str(tmp_path / "cp")
    for load_id in range(3):
        write(inbox, f"{load_id}.log", [HEAD.format(s=load_id, level="INFO", text=str(load_id))])
        if load_id == failed_load:
            with monkeypatch.context() as patch:
                patch.setattr(ingest, "partial_summaries", lambda entries: (_ for _ in ()).throw(Lost()))
                with pytest.raises(Exception, match="Lost"):
                    ingest.ingest_new_logs(spark, str(inbox), root, checkpoint)
            assert ingest.read_entries(spark, root).count() == load_id
            assert Snapshots(spark, root).unfinished()["load_id"] == load_id
        ingest.ingest_new_logs(spark, str(inbox), root, checkpoint)
    before = state(spark, root)
    assert len(before[0]) == 3 and Snapshots(spark, root).unfinished() is None
    ingest.full_reload(spark, str(inbox), root, str(tmp_path / "cp2"))
    assert state(spark, root) == before


def test_a_commit_that_the_checkpoint_has_not_seen_is_not_repeated(spark, tmp_path, monkeypatch):
    inbox, root, checkpoint = tmp_path / "in", str(tmp_path / "store"), str(tmp_path / "cp")
    write(inbox, "a.log", [HEAD.format(s=1, level="INFO", text="one")])
    real = ingest._load

    def then_lost(*args):
        real(*args)
        raise Lost()

    with monkeypatch.context() as patch:
        patch.setattr(ingest, "_load", then_lost)
        with pytest.raises(Exception, match="Lost"):
            ingest.ingest_new_logs(spark, str(inbox), root, checkpoint)
    write(inbox, "b.log", [HEAD.format(s=2, level="INFO", text="two")])
    ingest.ingest_new_logs(spark, str(inbox), root, checkpoint)
    assert rows(ingest.read_summary(spark, root, "user")) == [("ann", 2)]


def test_a_first_run_without_files_goes_on_later(spark, tmp_path):
    inbox, root, checkpoint = tmp_path / "in", str(tmp_path / "store"), str(tmp_path / "cp")
    inbox.mkdir()
    for _ in range(2):
        ingest.ingest_new_logs(spark, str(inbox), root, checkpoint)
        assert state(spark, root) == ([], {n: [] for n in ingest.SUMMARY_KEYS})
        assert ingest.read_stats(spark, root).count() == 0
    write(inbox, "a.log", [HEAD.format(s=1, level="INFO", text="one")])
    ingest.ingest_new_logs(spark, str(inbox), root, checkpoint)
    assert rows(ingest.read_summary(spark, root, "user")) == [("ann", 1)]


def test_a_reload_of_an_empty_folder_is_refused(spark, tmp_path):
    inbox, empty, root = tmp_path / "in", tmp_path / "typo", str(tmp_path / "store")
    empty.mkdir()
    write(inbox, "a.log", [HEAD.format(s=1, level="INFO", text="one")])
    ingest.ingest_new_logs(spark, str(inbox), root, str(tmp_path / "cp"))
    before = state(spark, root)
    with pytest.raises(ValueError, match="no file"):
        ingest.full_reload(spark, str(empty), root, str(tmp_path / "cp2"))
    assert state(spark, root) == before
    write(inbox, "b.log", [HEAD.format(s=2, level="INFO", text="two")])
    ingest.ingest_new_logs(spark, str(inbox), root, str(tmp_path / "cp"))
    assert ingest.read_entries(spark, root).count() == 2
    ingest.full_reload(spark, str(empty), root, str(tmp_path / "cp3"), allow_empty=True)
    assert state(spark, root) == ([], {n: [] for n in ingest.SUMMARY_KEYS})
    ingest.ingest_new_logs(spark, str(inbox), root, str(tmp_path / "cp3"))
    assert ingest.read_entries(spark, root).count() == 2


def test_a_reader_sees_all_old_or_all_new(spark, tmp_path, monkeypatch):
    inbox, root, checkpoint = tmp_path / "in", str(tmp_path / "store"), str(tmp_path / "cp")
    write(inbox, "a.log", [HEAD.format(s=1, level="INFO", text="one")])
    ingest.ingest_new_logs(spark, str(inbox), root, checkpoint)
    old, seen = state(spark, root), []
    held = ingest.LogSnapshot(spark, root)
    real = Snapshots.write

    def looked(self, *args, **kwargs):
        out = real(self, *args, **kwargs)
        seen.append(state(spark, root))
        return out

    write(inbox, "b.log", [HEAD.format(s=2, level="INFO", text="two")])
    with monkeypatch.context() as patch:
        patch.setattr(Snapshots, "write", looked)
        ingest.ingest_new_logs(spark, str(inbox), root, checkpoint)
        assert len(seen) == 3
        ingest.full_reload(spark, str(inbox), root, str(tmp_path / "cp2"))
    assert seen[:3] == [old] * 3 and len(state(spark, root)[0]) == 2
    assert all(len(s[0]) == 2 for s in seen[3:]) and len(seen) == 6
    store = Snapshots(spark, root)
    with pytest.raises(FileExistsError):  # a second writer of the same version
        monkeypatch.setattr(store, "latest", lambda: store.at(store.versions()[-2]))
        store.commit(Manifest(0, {}, {}))
    assert held.manifest.facts["load_id"] == 0


def test_files_without_entries(spark, tmp_path):
    inbox, store = tmp_path / "in", str(tmp_path / "store")
    write(inbox, "a.log", ["nothing here"])
    ingest.ingest_new_logs(spark, str(inbox), store, str(tmp_path / "cp"))
    assert ingest.read_entries(spark, store).count() == 0
    write(inbox, "b.log", [HEAD.format(s=2, level="INFO", text="two")])
    ingest.ingest_new_logs(spark, str(inbox), store, str(tmp_path / "cp"))
    assert rows(ingest.read_summary(spark, store, "ip")) == [("10.0.0.1", 1)]


@pytest.mark.parametrize("files_per_load", [1, 2])
def test_several_loads_in_one_run(spark, tmp_path, files_per_load):
    inbox, store = tmp_path / "in", str(tmp_path / "store")
    for i in range(3):
        write(inbox, f"{i}.log", [HEAD.format(s=i, level="INFO", text=str(i)), "more"])
    ingest.ingest_new_logs(spark, str(inbox), store, str(tmp_path / "cp"), files_per_load=files_per_load)
    assert [(r.message, r.details) for r in ingest.read_entries(spark, store).orderBy("message").collect()] == [
        ("0", "more"), ("1", "more"), ("2", "more"),
    ]
