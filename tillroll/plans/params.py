"""Parameters of the registered queries over the driver's tables.

The reference asks for the United Kingdom in 2011 and France; the driver's
tables name countries NATION_0..NATION_24 and hold orders from 1995 to 2001,
so the registered queries use a country and year present there.
"""

MARKET_COUNTRY = "NATION_7"
MARKET_YEAR = 1998
BEST_PRODUCT_COUNTRY = "Nation_3"  # matched case-insensitively
CHART_TOP_N = 15
