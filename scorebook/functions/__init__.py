from scorebook.functions.rates import average, overs_text, rate

__all__ = ["average", "overs_text", "rate"]
