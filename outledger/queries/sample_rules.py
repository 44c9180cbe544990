"""Rules that fit the test tables."""

from outledger.queries.views import AS_OF
from outledger.rules import Rules

RULES = Rules(
    excluded_brands=("Brand#3", "Brand#7"),
    division_patterns=(("%Brand#1%", "EAST"), ("%Brand#2%", "WEST")),
    brand_divisions={
        **{f"Brand#{i}": "EAST" for i in range(1, 13)},
        **{f"Brand#{i}": "WEST" for i in range(13, 22)},
    },
    receivable_patterns=(("%Brand#1%", "EAST"),),
    receivable_default="WEST",
    catalogue_brand="Brand#4",
    warehouse="W0",
    image_groups=("ECONOMY",),
    transporter="Carrier",
    sub_brands=(
        ("EAST", "Shirts", "U_Dis7"),
        ("EAST", "Knits", "U_Dis3"),
        ("WEST", "Sets", "U_Dis1"),
        ("WEST", "Kids", "U_Dis9"),
        ("WEST", "Misc", "U_Dis4"),
    ),
    scheme_list_from="1997-01-01 00:00:00",
    scheme_list_to="1998-12-31 00:00:00",
)

__all__ = ["AS_OF", "RULES"]
