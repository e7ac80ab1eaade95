from .runs import METHODS, run_ensemble, run_multiple_ensembles, windowed_forecasts
