"""Typed job parameters: roles of columns and stage settings (replaces a JSON config read by position)."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class SampleSpec:
    """Roles of the columns of a scoring sample, by name."""

    key: str | tuple[str, ...] = "epk_id"     # one column, or the columns of a composite key (client, report date)
    date_col: str = "report_dt"
    target: str = "trg_flag"
    numeric: tuple[str, ...] = ()
    categorical: tuple[str, ...] = ()

    @property
    def id_cols(self) -> list[str]:
        return list(dict.fromkeys([*([self.key] if isinstance(self.key, str) else self.key), self.date_col]))

    @property
    def features(self) -> list[str]:
        return list(self.numeric) + list(self.categorical)

    def with_features(self, features) -> "SampleSpec":
        features = list(features)
        return replace(self, numeric=tuple(f for f in features if f in self.numeric),
                       categorical=tuple(f for f in features if f in self.categorical))


@dataclass(frozen=True)
class SplitConfig:
    """DEV / TEST / OOT / VALID split. ``dev='ALL'`` means every date not in ``oot``."""

    oot: tuple[str, ...] = ()          # MON/YY tokens
    dev: str | tuple[str, ...] = "ALL"
    test_size: float = 0.2
    valid_size: float = 0.25
    seed: int = 19


@dataclass(frozen=True)
class BinnerConfig:
    max_bins: int = 20
    min_size: float = 0.05
    starts_from: int = 100
    fast: bool = False
    enforce_min_size: bool = False      # also between the tails: every bin holds at least min_size of the rows
