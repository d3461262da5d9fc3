"""DataFrame to DataFrame operators; entity columns travel with every row."""
