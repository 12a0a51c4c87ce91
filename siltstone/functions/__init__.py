"""Column expressions: typing (`casts`), cleaning (`cleaning`), validity (`validity`)."""
