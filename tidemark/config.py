"""What a run needs to know: the indicators of interest, column names and rules."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

# Text that stands for "no value" in a snapshot file.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


@dataclass(frozen=True)
class Indicator:
    """One measured column of the wide snapshot and how it is described once unpivoted."""

    source_col: str
    code: str
    name: str
    category: str
    unit: str


# The vaccination indicators of the public coverage file.
VACCINATION_INDICATORS = (
    Indicator("Measles, first dose (MCV1)", "measles_mcv1", "Measles (MCV1)", "vaccination", "%"),
    Indicator("Diphtheria/tetanus/pertussis (DTP3)", "dtp3", "DTP3", "vaccination", "%"),
    Indicator("Polio (Pol3)", "polio_pol3", "Polio (Pol3)", "vaccination", "%"),
    Indicator("Hepatitis B (HepB3)", "hepb3", "Hepatitis B (HepB3)", "vaccination", "%"),
)


@dataclass(frozen=True)
class Settings:
    """Rules of one data set. The defaults describe the public vaccination-coverage file."""

    indicators: Sequence[Indicator] = VACCINATION_INDICATORS
    main_indicator: str = "dtp3"
    name_col: str = "Entity"
    code_col: str = "Code"
    year_col: str = "Year"
    na_tokens: Sequence[str] = NA_TOKENS
    aggregate_prefix: str = "OWID_"
    country_len: int = 3
    min_year: int = 1980
    value_min: float = 0.0
    value_max: float = 100.0
    threshold: float = 80.0
    moderate_floor: float = 50.0

    @property
    def renames(self) -> dict[str, str]:
        """Source column names to the names used from here on."""
        return {self.name_col: "region_name", self.code_col: "iso_code", self.year_col: "year"}

    def max_year(self, as_of_year: int) -> int:
        """Figures for the coming year may already be published."""
        return as_of_year + 1
