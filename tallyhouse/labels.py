"""Labels and default thresholds."""

# Labels and limits that results are compared on.
PLATINUM, GOLD, SILVER, BRONZE = "Platinum", "Gold", "Silver", "Bronze"
SPEND_LIMITS = (1500, 1000, 500)

NEW_CUSTOMER, REPEAT_CUSTOMER = "New Customer", "Repeat Customer"

ONE_TIME = "One Time Buyer"
SAME_DAY = "Same Day Repeat Buyer"
SHORT_TERM, MID_TERM, LONG_TERM = "Short-term Buyer", "Mid-term Buyer", "Long-term Buyer"
GAP_LIMITS = (30, 180)

SINGLE_ITEM, MULTI_ITEM = "Single-item Order", "Multi-item Order"
BASKET_BINS = (("1 Item", 1, 1), ("2-3 Items", 2, 3), ("4-5 Items", 4, 5), ("6-10 Items", 6, 10))
LARGEST_BASKET = "10+ Items"

HIGH_BOTH = "High Quantity & High Value"
HIGH_QUANTITY, HIGH_VALUE, NORMAL_BASKET = (
    "High Quantity Basket", "High Value Basket", "Normal Basket"
)

HIGH_ORDERS, MEDIUM_ORDERS, LOW_ORDERS = (
    "High-value orders", "Medium-value orders", "Low-value orders"
)

VOLUME_HIGHEST, VOLUME_MIDDLE, VOLUME_LOWEST = "Highest", "Middle", "Lowest"
REVENUE_TIERS = ((1, "Highest"), (3, "High"), (5, "Medium"))
LOWEST_TIER = "Lower"

PEAK, NORMAL_SEASON, OFF_SEASON = "Peak Season", "Normal", "Off-Season"
WEEKEND, WEEKDAY = "Weekend", "Weekday"
PRICE_DRIVEN, VOLUME_DRIVEN, BALANCED = "Price Driven", "Volume Driven", "Balanced"

TOP_K = 10
FREQUENT_RETURNS = 4
HIGHLY_ACTIVE_ORDERS = 5
PARETO_PERCENT = 80
