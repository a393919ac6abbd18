"""Fixed values and run parameters.

The string values below are compared against by the reports, so they must
stay exactly as the source data and reports spell them.
"""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for right results)
# ---------------------------------------------------------------------------

# Fill values for missing categories.
NOT_INFORMED = "Não informado"
NO_COUNTRY_CODE = "XX"
NO_SITE = ""

# Flag text that means "yes" (compared after lower-casing).
FLAG_YES = "sim"

# Selection levels, highest first.
LEVEL_WINNER = "Vencedor"
LEVEL_FINALIST = "Finalista"
LEVEL_SEMIFINALIST = "Semifinalista"
LEVEL_ENTRANT = "Inscrito"

# Publication types; the first one is also the publisher name that marks it.
SELF_PUBLISHED = "Autopublicação"
TRADITIONAL_PUBLISHER = "Editora Tradicional"

# Author genders compared in the share-of-year reports.
COMPARED_GENDERS = ("Feminino", "Masculino")

# Age bands in their natural order.
AGE_BANDS = (
    "menos de 20 anos",
    "de 20 a 30 anos",
    "de 30 a 40 anos",
    "de 40 a 50 anos",
    "de 50 a 60 anos",
    "de 60 a 70 anos",
    "de 70 a 80 anos",
    "de 80 a 90 anos",
    "mais de 90 anos",
)

# Cell texts a CSV reader with pandas defaults turns into a missing value.
CSV_NULL_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# Labels of the four funnel stages in the long-form funnel view.
FUNNEL_STAGES = (
    ("inscritos", "Inscritos"),
    ("semifinalistas", "Semifinalistas"),
    ("finalistas", "Finalistas"),
    ("vencedores", "Vencedores"),
)

# Display names of the awarded-publishers table.
AWARDED_TABLE_NAMES = {
    "publisher_name": "Editora",
    "publisher_seat": "Sede",
    "inscricoes": "Inscrições",
    "finalistas": "Finalistas",
    "vitorias": "Vitórias",
}
TROPHY_FORMAT = "%d 🏆"

# Report thresholds and sizes.
MIN_ENTRIES_BOOK_COUNTRY = 10
MIN_ENTRIES_AUTHOR_COUNTRY = 5
MIN_ENTRIES_DASHBOARD_COUNTRY = 5
TOP_PUBLISHERS = 15
TOP_COUNTRIES_SHOWN = 8
TOP_PUBLISHERS_SHOWN = 12


# ---------------------------------------------------------------------------
# Time buckets (decade and period), a run parameter
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class TimeBuckets:
    """Decade is split at one year, periods by inclusive upper years."""

    decade_split: int
    decade_labels: tuple[str, str]
    period_upper: tuple[int, ...]
    period_labels: tuple[str, ...]

    def __post_init__(self):
        if len(self.period_labels) != len(self.period_upper) + 1:
            raise ValueError("need one more period label than upper bounds")


# The reference's ten editions, 2015-2024.
PRIZE_YEARS = TimeBuckets(
    decade_split=2020,
    decade_labels=("2010s", "2020s"),
    period_upper=(2018, 2021),
    period_labels=(
        "Início (2015-2018)",
        "Crescimento (2019-2021)",
        "Consolidação (2022-2024)",
    ),
)

# The driver's test tables carry order years 1995-2001.
TESTDATA_YEARS = TimeBuckets(
    decade_split=2000,
    decade_labels=("1990s", "2000s"),
    period_upper=(1997, 1999),
    period_labels=(
        "Início (1995-1997)",
        "Crescimento (1998-1999)",
        "Consolidação (2000-2001)",
    ),
)

# A dashboard selection other than the defaults on the test tables (some years,
# some genres), registered as the *_selected view keys.
SELECTED_YEARS = (1996, 1999)
SELECTED_GENRES = ("PROMO", "SMALL", "STANDARD")
