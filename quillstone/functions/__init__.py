"""Column functions of the price-file semantics: amounts, codes, items, text normalisation."""
