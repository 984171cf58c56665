"""The rules of the four label axes as SQL rows (axis, ordinal, label, pattern).

Written out apart from the package, so that a change to a rule there shows up as a difference.
"""

# Fixed values.
LADDER = """
('merchant_name', 0, 'Uber Eats', '%UBER%EATS%'),
('merchant_name', 1, 'Uber', '%UBER%TRIP%'),
('merchant_name', 2, 'Lyft', '%LYFT%'),
('merchant_name', 3, 'CVS Pharmacy', '%CVS%'),
('merchant_name', 4, 'Credit Card Payment', '%PAYMENT%THANK%YOU%'),
('merchant_name', 4, 'Credit Card Payment', '%INTERNET%PAYMENT%'),
('merchant_name', 4, 'Credit Card Payment', '%ONLINE%PAYMENT%'),
('merchant_name', 4, 'Credit Card Payment', 'PAYMENT'),
('merchant_name', 5, 'ATM Cash Extraction', '%ATM WITHDRAWAL%'),
('merchant_name', 6, 'Bank Fees', '%MAINTENANCE FEE%'),
('merchant_name', 7, 'Interest Charge', '%FINANCE CHARGE%'),
('merchant_name', 8, 'Netflix', '%NETFLIX%'),
('merchant_name', 9, 'Spotify', '%SPOTIFY%'),
('merchant_name', 10, 'Apple', '%APPLE.COM/BILL%'),
('merchant_name', 11, 'Hulu', '%HULU%'),
('merchant_name', 12, 'Shell', '%SHELL%'),
('merchant_name', 13, 'Chevron', '%CHEVRON%'),
('merchant_name', 14, 'ExxonMobil', '%EXXON%'),
('merchant_name', 15, 'Marriott', '%MARRIOTT%'),
('merchant_name', 16, 'MTA MetroCard', '%METROCARD%'),
('merchant_name', 17, 'Safeway', '%SFW_%'),
('merchant_name', 17, 'Safeway', '%SAFEWAY%'),
('merchant_name', 18, 'Costco', '%COSTCO%'),
('merchant_name', 19, 'Target', '%TARGET%'),
('merchant_name', 20, 'Amazon', '%AMAZON%'),
('merchant_name', 20, 'Amazon', '%AMZN%'),
('merchant_name', 21, 'McDonalds', '%MCDONALDS%'),
('merchant_name', 22, 'Chipotle', '%CHIPOTLE%'),
('merchant_name', 23, 'Starbucks', '%STARBUCKS%'),
('merchant_name', 24, 'Sweetgreen', '%SWEETGREEN%'),
('merchant_name', 25, 'Internal Transfer', '%AUTOMATIC PAYMENT%'),
('merchant_name', 25, 'Internal Transfer', '%ONLINE CC PAYMENT%'),
('category', 0, 'Transfer', '%PAYMENT%THANK%YOU%'),
('category', 0, 'Transfer', '%INTERNET%PAYMENT%'),
('category', 0, 'Transfer', '%ONLINE%PAYMENT%'),
('category', 0, 'Transfer', 'PAYMENT'),
('category', 0, 'Transfer', '%AUTOMATIC PAYMENT%'),
('category', 0, 'Transfer', '%ONLINE CC PAYMENT%'),
('category', 1, 'Cash', '%ATM WITHDRAWAL%'),
('category', 2, 'Fees', '%MAINTENANCE FEE%'),
('category', 2, 'Fees', '%FINANCE CHARGE%'),
('category', 3, 'Travel', '%MARRIOTT%'),
('category', 4, 'Medical', '%CVS%'),
('category', 5, 'Subscriptions', '%NETFLIX%'),
('category', 5, 'Subscriptions', '%SPOTIFY%'),
('category', 5, 'Subscriptions', '%HULU%'),
('category', 5, 'Subscriptions', '%APPLE.COM/BILL%'),
('category', 6, 'Groceries', '%INSTACART%'),
('category', 7, 'Meals', '%DOORDASH%'),
('category', 7, 'Meals', 'DD *%'),
('category', 7, 'Meals', '%UBER%EATS%'),
('category', 7, 'Meals', '%GRUBHUB%'),
('category', 8, 'Transport', '%METROCARD%'),
('category', 8, 'Transport', '%UBER%TRIP%'),
('category', 8, 'Transport', '%LYFT%'),
('category', 8, 'Transport', '%SHELL%'),
('category', 8, 'Transport', '%CHEVRON%'),
('category', 8, 'Transport', '%EXXON%'),
('category', 9, 'Groceries', '%SFW_%'),
('category', 9, 'Groceries', '%SAFEWAY%'),
('category', 9, 'Groceries', '%COSTCO%'),
('category', 10, 'Shopping', '%TARGET%'),
('category', 10, 'Shopping', '%AMAZON%'),
('category', 10, 'Shopping', '%AMZN%'),
('category', 11, 'Meals', '%MCDONALDS%'),
('category', 11, 'Meals', '%CHIPOTLE%'),
('category', 11, 'Meals', '%STARBUCKS%'),
('category', 11, 'Meals', '%SWEETGREEN%'),
('sub_category', 0, 'Food Delivery', '%UBER%EATS%'),
('sub_category', 1, 'Uber Rides', '%UBER%TRIP%'),
('sub_category', 2, 'Rideshare', '%LYFT%'),
('sub_category', 3, 'Pharmacy', '%CVS%'),
('sub_category', 4, 'Public Transit', '%METROCARD%'),
('sub_category', 5, 'Lodging', '%MARRIOTT%'),
('sub_category', 6, 'Grocery Delivery', '%INSTACART%'),
('sub_category', 7, 'Food Delivery', '%DOORDASH%'),
('sub_category', 7, 'Food Delivery', 'DD *%'),
('sub_category', 7, 'Food Delivery', '%GRUBHUB%'),
('sub_category', 8, 'Video Streaming', '%NETFLIX%'),
('sub_category', 8, 'Video Streaming', '%HULU%'),
('sub_category', 9, 'Audio Streaming', '%SPOTIFY%'),
('sub_category', 10, 'Gas', '%SHELL%'),
('sub_category', 10, 'Gas', '%CHEVRON%'),
('sub_category', 10, 'Gas', '%EXXON%'),
('sub_category', 11, 'Coffee Shop', '%STARBUCKS%'),
('sub_category', 12, 'Fast Food', '%CHIPOTLE%'),
('sub_category', 13, 'Wholesale Club', '%COSTCO%'),
('sub_category', 14, 'Grocery Store', '%SAFEWAY%'),
('sub_category', 14, 'Grocery Store', '%SFW_%'),
('sub_category', 15, 'Online Retail', '%AMAZON%'),
('sub_category', 15, 'Online Retail', '%AMZN%'),
('sub_category', 16, 'Department Store', '%TARGET%'),
('sub_category', 17, 'Digital Subscription', '%APPLE.COM/BILL%'),
('sub_category', 18, 'ATM Withdrawal', '%ATM WITHDRAWAL%'),
('sub_category', 19, 'Interest Charge', '%FINANCE CHARGE%'),
('sub_category', 20, 'Bank Fee', '%MAINTENANCE FEE%'),
('sub_category', 21, 'Credit Card Payment', '%PAYMENT%THANK%YOU%'),
('sub_category', 21, 'Credit Card Payment', '%INTERNET%PAYMENT%'),
('sub_category', 21, 'Credit Card Payment', '%ONLINE%PAYMENT%'),
('sub_category', 21, 'Credit Card Payment', 'PAYMENT'),
('channel', 0, 'doordash', '%DOORDASH%'),
('channel', 0, 'doordash', 'DD *%'),
('channel', 1, 'instacart', '%INSTACART%'),
('channel', 2, 'uber_eats', '%UBER%EATS%'),
('channel', 3, 'grubhub', '%GRUBHUB%'),
('channel', 4, 'online', '%UBER%TRIP%'),
('channel', 4, 'online', '%LYFT%'),
('channel', 4, 'online', '%NETFLIX%'),
('channel', 4, 'online', '%SPOTIFY%'),
('channel', 4, 'online', '%HULU%'),
('channel', 4, 'online', '%APPLE.COM/BILL%'),
('channel', 5, 'atm', '%ATM WITHDRAWAL%'),
('channel', 6, 'online', '%PRIME*MEMBERSHIP%'),
('channel', 7, 'ach', '%ACH%'),
('channel', 8, 'p2p', '%VENMO%'),
('channel', 8, 'p2p', '%PAYPAL%'),
('channel', 9, 'online', '%ONLINE%'),
('channel', 9, 'online', '%AMZN%')
"""
PREFIXES = ("DOORDASH*", "DD *", "INSTACART*", "GRUBHUB*")
