"""The export round trip keeps no more copies than its next step reads."""

from __future__ import annotations

from pathlib import Path

from supplylens.plans import registry
from supplylens.sources.schemas import SOURCE_COLUMNS


def test_copies_go_when_the_next_step_has_its_own(spark, small, tmp_path, monkeypatch):
    folder, seen = tmp_path / "extracts", []
    monkeypatch.setattr(registry, "new_folder", lambda spark, label: str(folder))

    def there(pattern: str) -> int:
        return sum(1 for p in folder.glob(pattern) if p.is_dir())

    def noted(df, path):
        if Path(path).parent.name == "again":
            seen.append((there("*.csv"), there("export/*"), there("again/*")))
        return write(df, path)

    write = registry.write_csv
    monkeypatch.setattr(registry, "write_csv", noted)
    found = registry.QUERIES["export_round_trip"](spark, small).collect()
    assert seen == [(0, 1, 0)] * len(SOURCE_COLUMNS)  # extracts, exports, exports written again
    assert not folder.exists()
    assert {(r.TableName, r.ColumnName) for r in found} == {(t, c) for t, kinds in SOURCE_COLUMNS.items() for c in kinds}
