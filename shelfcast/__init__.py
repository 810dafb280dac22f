"""shelfcast: demand-forecasting features, training and scoring as Spark DataFrame plans."""

from shelfcast.spec import RETAIL, PanelSpec

__all__ = ["PanelSpec", "RETAIL"]
