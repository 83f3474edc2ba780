"""Rule tables of the product-mix process.

Fixed values: every name, pattern, date and rate below must equal the published
rules for results to agree, so they are written out plainly. Callers may pass
their own tables (for example from ``sources.files.read_rules``) instead.
"""

from __future__ import annotations

from datetime import date

# --- fixed values: name cleaning --------------------------------------------
MOJIBAKE = [
    ("â€™", "'"),
    ("â€“", "-"),
    ("â€œ", '"'),
    ("â€\u009d", '"'),
    ("Ã©", "é"),
]
STRIPPED_SUFFIXES = ["club feast", "gameday", "side", "catering", "in house", "in-house", "ezcater"]

# --- fixed values: modifier and mix rules ------------------------------------
MODIFIER_BLOCKLIST = [
    "Please Include Utensils", "No Utensils", "Catering Utensils", "Napkins", "Include Napkins",
]
MODIFIER_TAGS = [
    ("Basmati Rice", "base"),
    ("Saag Greens", "base"),
    ("Mixed Greens", "base"),
    ("1/2 and 1/2 Base", "base"),
    ("Chicken Tikka", "main"),
    ("Spicy Chili Chicken", "main"),
    ("Cauliflower + Potato", "main"),
    ("Tandoori Paneer", "main"),
    ("Organic Tandoori Paneer", "main"),
    ("Lamb Kebab", "main"),
    ("Roasted Vegetables", "main"),
    ("1/2 and 1/2 Mains", "main"),
    ("Tomato Garlic (Butter Masala)", "sauce"),
    ("Spiced Chickpeas", "veggie"),
    ("That Fire Hot Sauce", "chutney"),
]
MIX_EXCLUSIONS = [
    "3PD MARKUP", "Fooda Guarantee", "Gift Card", "eGift Card",
    "Foodelicious 2026 Event (5/18/2026) Speaker fee for chef", "Catering Utensils",
    "Delivery Fee", "Premium Options Upcharge", "Order notes: YES utensils", "Order notes: NO utensils",
]

# Modifier types arrive as tags, singular or plural labels; all map to one set.
MODIFIER_TYPE_NAMES = [
    ("base", "Base"), ("bases", "Base"),
    ("main", "Main"), ("mains", "Main"),
    ("extra main", "Extra Main"), ("extra mains", "Extra Main"),
    ("veggie", "Veggie"), ("veggies", "Veggie"),
    ("extra veggie", "Extra Veggie"), ("extra veggies", "Extra Veggie"),
    ("sauce", "Sauce"), ("sauces", "Sauce"),
    ("chutney", "Chutney and Dressings"), ("chutney and dressings", "Chutney and Dressings"),
    ("topping", "Topping"), ("toppings", "Topping"),
    ("make it a meal", "Make it a Meal"),
    ("sides", "Make it a Meal"), ("drinks", "Make it a Meal"), ("sweets", "Make it a Meal"),
]
MEAL_PARTS = ["Sides", "Drinks", "Sweets"]
MEAL_TYPE = "Make it a Meal"

# --- fixed values: channels --------------------------------------------------
CHANNELS = [
    ("IN_HOUSE", "In-House"), ("APP", "App"), ("TPD", "3PD Delivery"),
    ("CATERING", "Catering"), ("OFFSITE", "Offsites"), ("OTHER", "Other"),
]
PAYMENT_CHANNEL_PATTERNS = [
    ("CATERING", ["%ezcater%", "%ez cater%", "%hungry%", "%sharebite%", "%territory%",
                  "%cater 2 me%", "%zerocater%", "%cater cow%", "%wck%", "%food fleet%"]),
    ("OFFSITE", ["%fooda%", "%aramark%", "%eurest%", "%metz%", "%taher%", "%foodworks%",
                 "%cureate%", "%guest services%"]),
    ("TPD", ["%doordash%", "%uber%", "%grubhub%", "%postmates%"]),
]
LINE_CHANNEL_PATTERNS = [
    ("CATERING", "dining_option", ["%catering%"]),
    ("CATERING", "sales_category", ["%catering%"]),
    ("APP", "dining_option", ["%open app%", "%online ordering%"]),
]
DEFAULT_CHANNEL = "IN_HOUSE"
ENGINEERING_CHANNELS = ["IN_HOUSE", "APP", "TPD"]
ONLINE_CHANNELS = ["APP", "TPD"]
COUNTER_MODIFIER_TYPES = ["Main", "Extra Main", "Make it a Meal"]

# --- fixed values: categories ------------------------------------------------
OFFSITE_MENU = "OFFSITE POP-UPS"
CATEGORY_ORDER = ["Entrees", "Sides", "NA Drinks", "Sweets", "Kids Meal", "Retail", "Alc Drinks"]
# menu group, category, sub-category
GROUP_CATEGORIES = [
    ("BOWLS", "Entrees", "Bowl"),
    ("BUILD YOUR OWN BOWL", "Entrees", "Bowl"),
    ("BYO", "Entrees", "Bowl"),
    ("PLATES", "Entrees", "Plates"),
    ("CLASSIC INDIAN PLATES", "Entrees", "Plates"),
    ("BURRITOS", "Entrees", "Burrito"),
    ("INDIAN BURRITOS", "Entrees", "Burrito"),
    ("CHEF CURATED BOWLS", "Entrees", "Bowl"),
    ("SIDES", "Sides", None),
    ("DRINKS", "NA Drinks", None),
    ("Cold Drinks", "NA Drinks", None),
    ("Hot Drinks", "NA Drinks", None),
    ("SWEETS", "Sweets", None),
    ("KIDS", "Kids Meal", "Kids Meal"),
    ("Beer", "Alc Drinks", "Beer"),
    ("Wine", "Alc Drinks", "Wine"),
    ("Liquor", "Alc Drinks", "Liquor"),
    ("Gameday", "Alc Drinks", "Gameday"),
]
# item, category override, sub-category
ITEM_CATEGORIES = [
    ("Garlic Naan", None, "Bread"), ("Naan", None, "Bread"), ("Roti", None, "Bread"),
    ("Mini Samosas", None, "Samosa"), ("Samosa Chaat", None, "Samosa"),
    ("Cucumber Raita", None, "Raita"),
    ("Side of Main", None, "Main"), ("Side of Grain", None, "Grain"),
    ("Side of Veggie", None, "Veggie"), ("Side of Sauce", None, "Sauce"),
    ("Chips + Chutney", None, "Chips"),
    ("That Fire Hot Sauce - Side", "Retail", "Sauce Bottle"),
    ("That Fire Hot Sauce (Bottle)", "Retail", "Sauce Bottle"),
    ("Mango Lassi", None, "Lassi"), ("Strawberry Lassi", None, "Lassi"),
    ("Blossom Lassi", None, "Lassi"),
    ("Mango Lassi for a Group - 1/2 Gallon", None, "Lassi"),
    ("Homemade Juice", None, "Juice"),
    ("Handcrafted Juice for a Group - 1/2 Gallon", None, "Juice"),
    ("Maine Root Fountain Soda", None, "Canned Soda"),
    ("Olipop - Cola", None, "Canned Soda"), ("Olipop - Lemon Lime", None, "Canned Soda"),
    ("Olipop - Root Beer", None, "Canned Soda"),
    ("Spindrift - Lemon", None, "Canned Soda"), ("Spindrift - Grapefruit", None, "Canned Soda"),
    ("LaCroix - Lime", None, "Canned Soda"), ("LaCroix - Grapefruit", None, "Canned Soda"),
    ("Open Water Still Water", None, "Water"), ("Open Water Sparkling Water", None, "Water"),
    ("Wild Kombucha - Mango Peach", None, "Kombucha"), ("Wild Kombucha - Ginger", None, "Kombucha"),
    ("Masala Chai", None, "Chai"), ("Masala Chai - Oat Milk", None, "Chai"),
    ("Iced Oat Masala Chai", None, "Chai"), ("Icaro - Spearmint Yerba Mate", None, "Chai"),
    ("Fresh Young Coconut", None, "Coconut"),
    ("Masala Chai Cookies", None, "Cookies"), ("Sweet Cardamom Yogurt", None, "Yogurt"),
    ("Mango Lassi Soft Serve", None, "Soft Serve"), ("Masala Chai Soft Serve", None, "Soft Serve"),
    ("Swirl Soft Serve", None, "Soft Serve"), ("Chocolate Chai Soft Serve", None, "Chai"),
    ("Spiked Lassi", None, "Liquor"), ("Tamarind Margarita", None, "Liquor"),
    ("Pabst Blue Ribbon - Gameday", None, "Gameday"),
    ("BYO Indian Burrito", None, "Burrito"),
]
# sub-category, category
SUBCATEGORY_CATEGORIES = [
    ("Bowls", "Entrees"), ("Bowl", "Entrees"), ("Burritos", "Entrees"), ("Burrito", "Entrees"),
    ("Plates", "Entrees"), ("Salad", "Entrees"), ("Roti", "Entrees"),
    ("Lassi", "NA Drinks"), ("Juice", "NA Drinks"), ("Chai", "NA Drinks"),
    ("Canned Soda", "NA Drinks"), ("Water", "NA Drinks"), ("Coconut", "NA Drinks"),
    ("Kombucha", "NA Drinks"),
    ("Bread", "Sides"), ("Samosa", "Sides"), ("Raita", "Sides"), ("Grain", "Sides"),
    ("Main", "Sides"), ("Sauce", "Sides"), ("Veggie", "Sides"), ("Chips", "Sides"),
    ("Cookies", "Sweets"), ("Soft Serve", "Sweets"), ("Yogurt", "Sweets"),
    ("Kids Meal", "Kids Meal"), ("KIDS", "Kids Meal"),
    ("Beer", "Alc Drinks"), ("Wine", "Alc Drinks"), ("Liquor", "Alc Drinks"), ("Gameday", "Alc Drinks"),
    ("Sauce Bottle", "Retail"), ("Retail", "Retail"),
]
OPERATIONAL_ITEMS = ["3PD MARKUP", "Delivery Fee", "Utensils", "BAG TAX"]
EXCLUDED_MENUS = ["CATERING", "CATERING - 3PD", "OFFSITE POP-UPS"]
EXCLUDED_GROUPS = [
    "Aramark", "BAG TAX", "Cater Cow", "Catering Bundles", "Catering Packages - BYO Bowl Bar",
    "EzCater + Relish Individually Packaged Bowls", "EzCater Additional Items",
    "EzCater Catering Packages", "EzCater Drinks", "EzCater Sides + Sweets",
    "Fooda", "HUNGRY", "Metz", "Sharebite", "Taher", "TERRITORY", "ZeroCater", "Club Feast",
    "Cureate", "EF Tours", "Eurest", "Individually Packaged Bowls",
    "Individually Packaged Indian Burritos", "Individually Packaged Plates",
    "Indian Burrito Boxes", "3PD MARKUPS", "Additional Items",
]
EXCLUDED_ITEMS = ["Delivery Fee", "Utensils", "3PD MARKUP", "BAG TAX"]
EXTERNAL_ITEM_NAMES = [
    ("Grain Bowl", "BYO Grain Bowl"),
    ("Salad Bowl", "BYO Salad Bowl"),
    ("Greens + Grains Bowl", "BYO Greens + Grains Bowl"),
    ("Grain Bowl - In House", "BYO Grain Bowl"),
    ("Salad Bowl - In House", "BYO Salad Bowl"),
    ("Greens + Grains Bowl - In House", "BYO Greens + Grains Bowl"),
    ("byo Grain Bowl - In House", "BYO Grain Bowl"),
    ("byo Salad Bowl - In House", "BYO Salad Bowl"),
    ("byo Greens + Grains Bowl - In House", "BYO Greens + Grains Bowl"),
    ("Cauliflower + Quinoa - In House", "Spiced Cauli + Quinoa Bowl"),
    ("Cauliflower + Quinoa Bowl", "Spiced Cauli + Quinoa Bowl"),
    ("Burrito - In House", "BYO Indian Burrito"),
    ("Maine Root Fountain Soda - In House", "Maine Root Fountain Soda"),
    ("Homemade Juice - In House", "Homemade Juice"),
]

# --- fixed values: cost and engineering --------------------------------------
PLATE_SUBCATEGORY = "Plates"
PLATE_DROPPED_TYPES = ["Main", "Extra Main"]
PLATE_ITEMS = [
    "Butter Chicken", "Saag Paneer", "Saag Chole", "Coconut Veggie Curry",
    "Chicken Tikka Masala", "Aloo Gobhi", "Paneer Butter Masala",
    "Chicken Curry", "Lamb Kofta Korma", "Paneer Tikka Masala",
]
NO_COST_EXPECTED = ["Side of Main", "Side of Veggie", "Side of Grain"]
ZERO_COST_PATTERN = r"(?i)^skip|^no |utensil|plastic bag|bag|disposable"
THIRD_PARTY_COST_RATE = "1.18"
MIX_THRESHOLD_FACTOR = "0.7"
RETENTION_GREEN = "0.28"
RETENTION_AMBER = "0.15"

# --- fixed values: fiscal periods (label, period key, first day, last day) ---
FISCAL_PERIODS = [
    ("P1 2026", 202601, date(2025, 12, 31), date(2026, 1, 27)),
    ("P2 2026", 202602, date(2026, 1, 28), date(2026, 2, 24)),
    ("P3 2026", 202603, date(2026, 2, 25), date(2026, 3, 24)),
    ("P4 2026", 202604, date(2026, 3, 25), date(2026, 4, 22)),
    ("P5 2026", 202605, date(2026, 4, 23), date(2026, 5, 20)),
    ("P6 2026", 202606, date(2026, 5, 21), date(2026, 6, 17)),
    ("P7 2026", 202607, date(2026, 6, 18), date(2026, 7, 15)),
    ("P8 2026", 202608, date(2026, 7, 16), date(2026, 8, 12)),
]

# --- fixed values: pull window and retention extract columns -----------------
BACKPAD_DAYS = 2
MAX_WINDOW_DAYS = 45
RETENTION_COLUMNS = [
    ("Item", "item_name", "string"),
    ("Item id", "item_id", "string"),
    ("Item revenue", "revenue", "decimal(12,2)"),
    ("Item revenue per location", "revenue_per_loc", "decimal(12,2)"),
    ("Item revenue percentage", "revenue_pct", "decimal(8,6)"),
    ("Item volume", "volume", "decimal(10,0)"),
    ("Item volume per location", "volume_per_loc", "decimal(10,2)"),
    ("Item volume percentage", "volume_pct", "decimal(8,6)"),
    ("Item aov", "aov", "decimal(10,2)"),
    ("Item guests", "guests", "decimal(10,0)"),
    ("N day item return rate", "return_rate", "decimal(8,6)"),
    ("N day item reorder rate", "reorder_rate", "decimal(8,6)"),
    ("Business date previous start", "prev_period_start", "date"),
    ("Business date previous end", "prev_period_end", "date"),
    ("Item revenue previous", "revenue_prev", "decimal(12,2)"),
    ("Item revenue per location previous", "revenue_per_loc_prev", "decimal(12,2)"),
    ("Item revenue percentage previous", "revenue_pct_prev", "decimal(8,6)"),
    ("Item volume previous", "volume_prev", "decimal(10,0)"),
    ("Item volume per location previous", "volume_per_loc_prev", "decimal(10,2)"),
    ("Item volume percentage previous", "volume_pct_prev", "decimal(8,6)"),
    ("Item aov previous", "aov_prev", "decimal(10,2)"),
    ("Item guests previous", "guests_prev", "decimal(10,0)"),
    ("N day item return rate previous", "return_rate_prev", "decimal(8,6)"),
    ("N day item reorder rate previous", "reorder_rate_prev", "decimal(8,6)"),
]
