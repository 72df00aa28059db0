"""Query parameters, and the plans composed from operators to answer them."""
