"""DataFrame -> DataFrame operators: cleaning, features, reports, EDA, portfolio, forecasting."""
