"""Forecasts of the coming months per station.

Tables inside this package are long and carry every gas at once:

* history: ``gas, estacion, cod_dis, fecha, dato``, one row per station and day;
* features: history plus the columns of ``features.FEATURES``;
* predictions: ``gas, estacion, cod_dis, fecha, yhat``.

``gas`` is the *domain*: nothing is ever learnt across gases.  Backtests add
``fold`` to the domain and run through the very same functions.
"""
