"""Every tunable constant of the demand plan, in one frozen dataclass.

Defaults are the values the original notebook used. Parameters it defined
but never read (a z threshold of 1.8, a minimum visit count, an uplift of
1.04, a route cap, an optimiser switch) are not carried: the numbers that
were actually applied are the ones below.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

# The 20 client channel codes with their names.
CHANNELS: tuple[tuple[str, str], ...] = (
    ("D02", "D02-Autoservicios"),
    ("D03", "D03-Clientes de contado"),
    ("D06", "D06-Mayoristas"),
    ("D10", "D10-Empleados"),
    ("D12", "D12-Ganaderos"),
    ("D13", "D13-Gobierno"),
    ("D17", "D17-Tiendas de conveniencia"),
    ("D18", "D18-Vending"),
    ("D19", "D19-Clientes"),
    ("D20", "D20-Intercompañias(filiales)"),
    ("D21", "D21-Tradicional"),
    ("D22", "D22-Institucionales"),
    ("D24", "D24-Otros (Provisional)"),
    ("D27", "D27-Horeca"),
    ("D28", "D28-E-Commerce"),
    ("D29", "D29-Expendio"),
    ("D30", "D30-Maquila"),
    ("D31", "D31-Club de Precios"),
    ("K01", "K01-Proveedor Ganadero"),
    ("K05", "K05-Acreedores Empleados"),
)

# Weekday number (Monday = 0) to the column name used in the
# day mix. Sunday (6) has no name on purpose: the original plan only
# distributes volume over Monday..Saturday.
DAY_NAMES: tuple[tuple[int, str], ...] = (
    (0, "Lunes"),
    (1, "Martes"),
    (2, "Miercoles"),
    (3, "Jueves"),
    (4, "Viernes"),
    (5, "Sabado"),
)

# Volume bands, lowest first.
BANDS: tuple[str, ...] = ("Bajo", "Medio Bajo", "Medio Alto", "Alto")


@dataclass(frozen=True)
class PlanParams:
    # extract window and scope
    start: dt.date = dt.date(2021, 7, 18)
    end: dt.date = dt.date(2023, 11, 19)
    units: tuple[str, ...] = ("D004",)
    channels: tuple[str, ...] = tuple(c for c, _ in CHANNELS)
    # sales header status codes kept by the extract
    tipo: int = 1
    tipo_fase_int_sal: int = 1
    tipo_movimiento: int = 2
    # outlier removal
    p_cut: float = 0.95
    z_hi: float = 1.75
    z_lo: float = -1.55
    z_single: float = 10.0          # z given to a group of one row
    z_mix: float = 2.0              # one-sided cut before the mix medians
    z_curve_null: float = 1.0       # curve points with z >= this become gaps
    visit_p_cut: float = 0.95
    # forecast target
    forecast_week: int = 46
    forecast_month: int = 11
    uplift: float = 1.06
    # product mix
    blend_weight: float = 0.1       # 0 -> history only, 1 -> segments only
    share_cut: float = 100.0
    share_decimals: int = 9         # shares are rounded before cuts/rounding
    days: tuple[tuple[int, str], ...] = DAY_NAMES
    # crates
    crate_round_threshold: float = 0.3
    # segments (k-means)
    k_min: int = 2
    k_max: int = 9
    kmeans_seeds: tuple[int, ...] = tuple(range(10))
    kmeans_max_iter: int = 300
    # boosted trees
    gbt_max_iter: int = 600
    gbt_max_depth: int = 10
    gbt_step: float = 0.1
    gbt_patience: int = 100
    gbt_block: int = 10             # trees between two looks at the validation error
    gbt_max_bins: int = 256         # split candidates per feature
    split_buckets: int = 25         # 16 train / 4 validation / 5 test
    split_train: int = 16
    split_val: int = 4
    # rolling-origin test: Mondays at which the plan is cut, and weeks forecast from each
    backtest_origins: tuple[dt.date, ...] = (dt.date(2023, 8, 28), dt.date(2023, 9, 25), dt.date(2023, 10, 23))
    backtest_weeks: int = 4
    # blend: also products that only a client's segment buys
    allow_new_products: bool = False
    # result rounding used by the checked outputs
    iso_year: bool = False

    def with_(self, **kw) -> "PlanParams":
        return replace(self, **kw)




def fixture_params(**kw) -> PlanParams:
    """Parameters for the driver's synthetic tables: every unit and the whole
    date range, so that registered queries cover the whole input."""
    base = PlanParams(
        start=dt.date(1990, 1, 1),
        end=dt.date(2030, 12, 31),
        units=("D001", "D002", "D003", "D004", "D005"),
        backtest_origins=(dt.date(2001, 4, 30), dt.date(2001, 5, 28), dt.date(2001, 6, 25)),
    )
    return replace(base, **kw)
