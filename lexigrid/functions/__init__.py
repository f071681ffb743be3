"""Column expressions: text analysis, stemming, small formatting helpers."""
