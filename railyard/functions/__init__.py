"""Column functions: cleansing, rates, time."""
