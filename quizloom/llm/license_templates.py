"""Wording of well-known licences in template markup, as public texts have it; fixed values, a parameter of ``licenses.scan``.

``[[...]]`` may be left out, ``<<name:2-9>>`` stands for two to nine words of any kind; all other words are mandatory.
"""

from __future__ import annotations

AS_IS = """this software is provided by the copyright holders and contributors "as is" and any express or implied warranties, including, but not limited to, the implied
warranties of merchantability and fitness for a particular purpose are disclaimed. in no event shall the copyright <<holder:1-20>> be liable for any direct, indirect, incidental,
special, exemplary, or consequential damages (including, but not limited to, procurement of substitute goods or services; loss of use, data, or profits; or business interruption)
however caused and on any theory of liability, whether in contract, strict liability, or tort (including negligence or otherwise) arising in any way out of the use of this
software, even if advised of the possibility of such damage"""
BSD = """redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
[[1.]] redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
[[2.]] redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials
provided with the distribution. """

TEMPLATES: list[tuple[str, str]] = [
    ("mit", "under the terms of the mit license"),
    ("mit", "SPDX-License-Identifier: MIT"),
    ("mit", """permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "software"), to deal in
     the software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the software,
     and to permit persons to whom the software is furnished to do so, subject to the following conditions: the above copyright notice and this permission notice
     [[(including the next paragraph)]] shall be included in all copies or substantial portions of the software. the software is provided "as is", without warranty of any kind,
     express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement. in no event shall the
     <<holders:1-20>> be liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise, arising from, out of or in connection with the
     software or the use or other dealings in the software"""),
    ("apache-2.0", "under the [[terms of the]] apache [[software]] license[[,]] [[version]] 2.0"),
    ("apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("apache-2.0", """licensed under the apache license, version 2.0 (the "license"); you may not use this file except in compliance with the license. you may obtain a copy of the
     license at <<address:0-12>> unless required by applicable law or agreed to in writing, software distributed under the license is distributed on an "as is" basis, without
     warranties or conditions of any kind, either express or implied. see the license for the specific language governing permissions and limitations under the license"""),
    ("bsd-2-clause", BSD + AS_IS),
    ("bsd-3-clause", BSD + """[[3.]] neither the name of <<holder:1-20>> [[nor the names of its contributors]] may be used to endorse or promote products derived from this software without
     specific prior written permission. """ + AS_IS),
    ("isc", """permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this
     permission notice appear in all copies"""),
    ("gpl-2.0", "under the [[terms of the]] gnu general public license [[(gpl)]] [[as published by the free software foundation; either]] [[,]] version 2"),
    ("gpl-3.0", "under the [[terms of the]] gnu general public license [[(gpl)]] [[as published by the free software foundation, either]] [[,]] version 3"),
    ("lgpl-2.1", "under the [[terms of the]] gnu lesser general public license [[(lgpl)]] [[as published by the free software foundation; either]] version 2.1"),
    ("lgpl-3.0", "under the [[terms of the]] gnu lesser general public license [[(lgpl)]] [[as published by the free software foundation, either]] version 3"),
    ("agpl-3.0", "under the [[terms of the]] gnu affero general public license [[(agpl)]] [[as published by the free software foundation, either]] version 3"),
    ("mpl-2.0", """this source code form is subject to the terms of the mozilla public license, v. 2.0. if a copy of the mpl was not distributed with this file, you can obtain one at
     [[https://]] [[http://]] mozilla.org/mpl/2.0"""),
    ("mpl-2.0", "under the [[terms of the]] mozilla public license [[,]] [[version]] 2.0"),
    ("cc0-1.0", "dedicated to the public domain under <<article:0-2>> cc0"),
    ("cc-by-4.0", "under [[a]] [[the]] creative commons attribution 4.0 [[international]] [[public]] license"),
    ("cc-by-4.0", "licensed under [[a]] [[the]] cc by 4.0"),
    ("cc-by-sa-4.0", "under [[a]] [[the]] creative commons attribution sharealike 4.0 [[international]] [[public]] license"),
    ("cc-by-sa-4.0", "licensed under [[a]] [[the]] cc by sa 4.0"),
    ("cc-by-nc-4.0", "under [[a]] [[the]] creative commons attribution noncommercial 4.0 [[international]] [[public]] license"),
    ("cc-by-nc-4.0", "licensed under [[a]] [[the]] cc by nc 4.0"),
    ("unlicense", "free and unencumbered software released into the public domain"),
    ("zlib", """provided 'as-is', without any express or implied warranty. in no event will the authors be held liable for any damages arising from the use of this software. permission is
     granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions"""),
    ("bsl-1.0", "distributed under the boost software license, version 1.0"),
    ("proprietary", "copyright [[(c)]] <<years and holder:1-12>> all rights reserved"),
]
