"""panelforge: DataFrame operators for entity x date panels and intraday bars."""
