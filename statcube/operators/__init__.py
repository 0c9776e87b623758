"""Operators on cube, member, series and catalog frames."""
