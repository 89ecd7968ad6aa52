"""Ready-made configuration: words of the audit report and the variants of the blend block.

Fixed values: they must equal what existing consumers of the reports read. Places, divisions and people
are not part of it; those are always handed in.
"""

from __future__ import annotations

from ..operators.audit import Labels
from ..operators.blends import Blend

AUDIT_LABELS = Labels(
    cumulative="Накопительный",
    daily="Суточный",
    yes="Да",
    no="Нет",
    created="Создание",
    deleted="Удаление",
    edited="Редактирование",
    system="Система",
    info="Инфо",
    dependency_attribute="Состояние зависимости",
    dependency_prefix="Зависимость потерь ",
    dependency_title="Зависимость потерь: ",
)

BLEND_SUFFIX = " (смешение)"
BLEND_MARK = "%смешение%"
SYSTEM_MARK = "%Система%"

# product, blend row, pattern in the ledger, variant
BLENDS = (
    Blend("Продукт №10", "Продукт №10 (смешение)", "%Продукт №10%"),
    Blend("Продукт №11", "Продукт №11 (смешение)", "%Продукт №11", "%Продукт №11%", daily="coming"),
    Blend("Продукт №1", "Продукт №1 (смешение)", "%Продукт №1%", shipped_month="none"),
    Blend("Продукт №2", "Продукт №2 (смешение)", "%Продукт №2%"),
    Blend("Продукт №3", "Продукт №3 (смешение)", "%Продукт №3%", literal=True),
    Blend("Продукт №4", "Продукт №4 (смешение)", "%Продукт №4%", daily="plain"),
    Blend("Продукт №5", "Продукт №5 (смешение)", "%Продукт №5%", daily="plain"),
    Blend("Продукт №6", "Продукт №6 (смешение)", "%Продукт №6%", shipped_month="month", opening="by_kind"),
    Blend("Продукт №7", "Продукт №7 (смешение)", "%Продукт №7%", opening="by_kind"),
    Blend(
        "Продукт №8", "Продукт №8 (смешение)", "%Продукт №8%", daily="plain", shipped_day="by_kind", shipped_month="none",
        rewrite_base=False,
    ),
    Blend("Продукт №9", "Продукт №9 (смешение)", "%Продукт №9%", opening="by_kind"),
)
CONSOLIDATED = ("Продукт №17", "Продукт №16", "Продукт №15", "Продукт №14")
CONSOLIDATED_INTO = "Продукт №13"
MOVED = ("Продукт №19", "Продукт №18")
CORRECTED = (
    "Продукт №1 (смешение)", "Продукт №2 (смешение)", "Продукт №6 (смешение)", "Продукт №8 (смешение)", "Продукт №7 (смешение)",
    "Продукт №9 (смешение)",
)
