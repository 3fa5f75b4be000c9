"""rulelake.functions"""
