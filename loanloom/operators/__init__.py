"""Analytics, modelling and stress operators; DataFrame in, DataFrame out."""
