"""Fixed values that results must reproduce (labels, cut points, rates and
generator constants of the surveyed pipeline), stated once, in natural order.

Everything else in the library (fixture choices, table names, salts) is our
own and lives next to the code that uses it.
"""

# --- fixed values ------------------------------------------------------------
# Silver labels and cut points
BAND_LABELS = ("Baixo", "Médio", "Alto")            # price and stock bands
PRICE_CUTS = (10, 20)                               # price band upper bounds (<)
STOCK_CUTS = (105, 115)                             # stock band upper bounds (<)
POPULARITY_LABELS = ("Top", "Média", "Long tail")   # tiers by popularity rank
POPULARITY_CUTS = (10, 40)                          # tier upper bounds (<=)
STAR_RANK = 10                                      # rank <= 10 is a star product
COST_RATE = 0.65                                    # estimated cost = 65 % of list price
REGION_IN_LABEL = "Grande Vitória"
REGION_OUT_LABEL = "Interior"
REGION_CITIES = ("Vitoria", "Serra", "Vila Velha", "Cariacica", "Guarapari")
CAPITAL_CITY = "Vitoria"
WEEKEND_DAYS = (1, 7)                               # dayofweek: 1 = Sunday, 7 = Saturday

# Bronze generators
CATEGORIES = ("Acessórios", "Bebidas", "Cozinha", "Limpeza", "Higiene", "Snacks")  # by p % 6
BRANDS = ("MarcaA", "MarcaB", "MarcaC", "MarcaD")                                   # by p % 4
CITIES = ("Vitoria", "Serra", "Vila Velha", "Cariacica", "Guarapari", "Linhares")   # by (i-1) % 6 + 1
STATE = "ES"
N_PRODUCTS = 120
N_STORES = 6
ZIPF_S = 1.1                                        # popularity weight = rank ** -1.1, normalised
PRICE_BASE, PRICE_MOD, PRICE_SPREAD = 5, 20, 10     # price = 5 + p % 20 + U * 10
STOCK_TOP_RANK = 40                                 # stock only for the 40 most popular products
STOCK_BASE, STOCK_SPREAD = 100, 20                  # stock quantity = 100 + draw mod 20 -> 100..119
TX_PER_DAY = 220                                    # transactions per day over all stores ...
TX_DIVISOR = 6                                      # ... divided by a fixed 6 (not the store count)
TX_LOW, TX_WIDTH = 0.8, 0.4                         # day-store volume factor U[0.8, 1.2]
SEASON_AMPLITUDE = 0.15                             # factor = 1 + 0.15 sin(2 pi (dayofweek - 1) / 7)
BASKET_MAX = 6                                      # items = ceil(min(6, 1 + 3 U1 + 2 U2))
PICK_FACTOR = 3.0                                   # an item draw u matches products with 3 w > u
U_RESOLUTION = 1_000_000                            # item draws have 1e-6 resolution
QTY_P2, QTY_P3 = 0.35, 0.10                         # qty = 1 + [U < .35] + [U < .10]
DISC_P, DISC_LOW, DISC_WIDTH = 0.12, 0.05, 0.15     # 12 % of lines get a rate in U[.05, .20]
# -----------------------------------------------------------------------------
