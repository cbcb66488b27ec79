"""Constants and word lists that results have to reproduce exactly."""

# Constants of the conformed layer.
CURRENCY = "INR"
SOURCE_SYSTEM = "kaggle_csv"

# Text forms of timestamps.
RAW_TIMESTAMP_FORMAT = "dd-MM-yyyy HH:mm"
BATCH_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"

# The default calendar.
CALENDAR_START = "2015-01-01"
CALENDAR_END = "2030-12-31"
FISCAL_YEAR_FIRST_MONTH = 4

# Status rules (name -> category, display order) and final states.
STATUS_CATEGORY = {"Failed": "Failed", "Pending": "Pending", "Successful": "Success"}
STATUS_DISPLAY_ORDER = {"Pending": 1, "Successful": 2, "Failed": 3}
TERMINAL_STATUSES = ["Failed", "Successful"]

# Words that mark a renamed merchant.
RENAME_KEYWORDS = [
    "Pvt Ltd", "Ltd", "Internet", "Media", "Technologies",
    "Entertainment", "Retail", "E-Commerce", "Fleet",
]

# Eastern time is modelled as Indian time minus ten and a half hours.
EST_SHIFT_MINUTES = 630

# Weights of the synthetic categoricals.
PAYMENT_METHOD_WEIGHTS = {
    "UPI": 0.60, "Credit Card": 0.15, "Debit Card": 0.15,
    "Wallet Balance": 0.07, "Bank Transfer": 0.03,
}
STATUS_WEIGHTS = {"Successful": 0.95, "Failed": 0.04, "Pending": 0.01}
DEVICE_WEIGHTS = {"Android": 0.60, "iOS": 0.30, "Web": 0.10}
LOCATION_WEIGHTS = {"Urban": 0.70, "Suburban": 0.20, "Rural": 0.10}

# Synthetic amounts, fees, cashback and points.
AMOUNT_LOG_MEAN = 7.5
AMOUNT_LOG_SIGMA = 1.0
AMOUNT_BOUNDS = (100.0, 50000.0)
FEE_RATE_BOUNDS = (0.015, 0.03)
CASHBACK_RATE_BOUNDS = (0.0, 0.05)
POINTS_DIVISOR_BOUNDS = (10.0, 20.0)

# Shares of injected defects.
LATE_SHARE = 0.01
NULL_UPDATED_SHARE = 0.01
RENAME_SHARE = 0.02
TIME_ZONE_SHARE = 0.0133

# Merchants with a name of their own; the others are numbered.
NAMED_MERCHANTS = [
    "Amazon India", "Flipkart", "Meesho", "Myntra", "Ajio", "Snapdeal",
    "Swiggy", "Zomato", "Dunzo", "BigBasket", "Blinkit",
    "MakeMyTrip", "Goibibo", "Ola", "Uber India", "Redbus",
    "BookMyShow", "Netflix India", "Amazon Prime Video", "Hotstar",
    "Paytm Mall", "PhonePe Store", "Reliance Digital", "Croma",
    "ShopEasy India", "QuickMart", "TechWorld", "FashionHub", "FoodExpress",
    "GroceryKing", "TravelMate", "EntertainPlus", "HealthFirst", "EduPoint",
]

# New names of renamed merchants; the others get " Ltd" appended.
MERCHANT_RENAMES = {
    "Amazon India": "Amazon India Pvt Ltd",
    "Flipkart": "Flipkart Internet Pvt Ltd",
    "Swiggy": "Swiggy Ltd",
    "Zomato": "Zomato Media Pvt Ltd",
    "MakeMyTrip": "MakeMyTrip India Pvt Ltd",
    "Paytm Mall": "Paytm E-Commerce Pvt Ltd",
    "BookMyShow": "BookMyShow Entertainment Pvt Ltd",
    "Reliance Digital": "Reliance Retail Digital",
    "Ola": "Ola Fleet Technologies",
    "PhonePe Store": "PhonePe Internet Pvt Ltd",
}

# Product names by category, categories in natural order.
PRODUCTS = {
    "Electronics": [
        "Samsung Galaxy S23", "iPhone 15", "OnePlus 11", "Realme Narzo",
        "MacBook Air M2", "Dell XPS 13", "HP Pavilion", "Lenovo ThinkPad",
        "Sony WH-1000XM5", "Boat Airdopes", "JBL Flip 6", "Amazon Echo Dot",
        'Samsung 55" TV', "LG OLED TV", "Mi TV", "Canon EOS Camera",
    ],
    "Fashion": [
        "Nike Air Max", "Adidas Ultraboost", "Puma RS-X", "Reebok Classic",
        "Levi's Jeans", "H&M T-Shirt", "Zara Dress", "Van Heusen Shirt",
        "Allen Solly Trousers", "Peter England Suit", "Woodland Shoes",
        "Bata Sandals", "Fastrack Watch", "Titan Watch", "Ray-Ban Sunglasses",
    ],
    "Food": [
        "Biryani Meal", "Pizza Large", "Burger Combo", "Masala Dosa",
        "Chicken Tikka", "Paneer Butter Masala", "Veg Thali", "Noodles Bowl",
        "Sushi Platter", "Pasta Carbonara", "Ice Cream Tub", "Cake 1kg",
    ],
    "Groceries": [
        "Rice 25kg", "Wheat Flour 10kg", "Cooking Oil 5L", "Sugar 5kg",
        "Tea Powder 1kg", "Coffee Powder 500g", "Milk 2L", "Eggs Dozen",
        "Vegetables Basket", "Fruits Basket", "Chicken 1kg", "Fish 1kg",
    ],
    "Travel": [
        "Flight Delhi-Mumbai", "Train Ticket AC", "Bus Ticket Volvo",
        "Cab Ride 20km", "Hotel 1 Night", "Resort Package", "Tour Package",
        "Car Rental Daily", "Bike Rental", "Metro Card Recharge",
    ],
    "Entertainment": [
        "Movie Ticket 2", "Concert Pass", "IPL Match Ticket", "Game CD",
        "Spotify Premium", "YouTube Premium", "Gaming Console", "VR Headset",
        "Book Novel", "Magazine Subscription", "Streaming Bundle",
    ],
    "Health": [
        "Medicine Pack", "Vitamin Supplements", "Protein Powder 1kg",
        "Gym Membership", "Yoga Mat", "Fitness Band", "Blood Test Package",
        "Doctor Consultation", "Health Insurance Premium", "Medical Checkup",
    ],
    "Education": [
        "Online Course Fee", "Textbook Set", "Laptop for Study", "Notebook Pack",
        "School Fee Payment", "Tuition Fee", "Certification Exam", "Workshop Pass",
        "E-Learning Subscription", "Educational Software", "Study Lamp",
    ],
    "Bills": [
        "Electricity Bill", "Water Bill", "Gas Cylinder", "Mobile Recharge",
        "DTH Recharge", "Broadband Bill", "Credit Card Payment", "Loan EMI",
        "Insurance Premium", "Property Tax", "Maintenance Charges",
    ],
    "Others": [
        "Gift Card", "Donation", "Subscription Box", "Pet Food", "Plants",
        "Home Decor Item", "Kitchenware", "Tools Set", "Sports Equipment",
        "Stationery Set", "Toys Pack", "Baby Products", "Cosmetics",
    ],
}
